"""Company-filing facts and training-data preparation as plain Spark DataFrame operators."""
