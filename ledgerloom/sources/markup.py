"""XML documents as nested columns.

`from_xml` needs the names of elements, but a fact's name and prefix differ from document to document. So every tag is
renamed first: <p:Name a="1"> becomes <e p="p" n="Name" a="1">. The renamed document has one kind of element, which a
schema can name, and Spark's XML reader does the rest: entities, CDATA sections, comments, nesting, quotes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The namespaces of instance documents, linkbases and schemas.
INSTANCE = "http://www.xbrl.org/2003/instance"
LINKBASE = "http://www.xbrl.org/2003/linkbase"
SCHEMA = "http://www.w3.org/2001/XMLSchema"

_NAME = r"[\w.-]++"


def element_schema(depth: int, attributes: Sequence[str]) -> str:
    """DDL of an element that has elements to a depth; every element has its name (_n), prefix (_p) and text (_VALUE)."""
    own = ", ".join(f"`_{a}`: string" for a in ("n", "p", *attributes))
    below = f", e: array<{element_schema(depth - 1, attributes)}>" if depth > 1 else ""
    return f"struct<{own}, `_VALUE`: string{below}>"


def elements(content: Column, depth: int, attributes: Sequence[str]) -> Column:
    """The elements directly below the root, as an array; null for what is no XML. Prefixes of attributes are ignored."""
    opened = F.regexp_replace(content, rf"<(?:({_NAME}):)?({_NAME})(?=[\s/>])", '<e p="$1" n="$2"')
    closed = F.regexp_replace(opened, rf"</(?:{_NAME}:)?{_NAME}\s*>", "</e>")
    return F.from_xml(closed, f"e array<{element_schema(depth, attributes)}>", {"ignoreNamespace": "true"})["e"]


def once(df: DataFrame, *kept: str, **columns: Column) -> DataFrame:
    """The columns `kept` of df and new ones that are computed once a row.

    The explosion of an array of one keeps Spark from writing them into every filter, column and lambda that uses them, each of which
    would compute them again, within a lambda for every element.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__once")
    return df.select(*kept, made).select(*kept, *[F.col(f"__once.{n}").alias(n) for n in columns])


def parsed(docs: DataFrame, depth: int, attributes: Sequence[str], *columns: str | Column) -> DataFrame:
    """`columns` of docs (content) and `e`, the elements of each document, parsed once."""
    return docs.select(*columns, F.explode(F.array(elements(F.col("content"), depth, attributes))).alias("e"))


def declared_namespaces(content: Column) -> Column:
    """(prefix, uri) of every namespace declaration; the default namespace has the empty prefix."""
    found = F.regexp_extract_all(content, F.lit(rf"""\sxmlns(?::{_NAME})?\s*=\s*(?:"[^"]*"|'[^']*')"""), F.lit(0))
    part = lambda d, k: F.regexp_extract(d, rf"""xmlns:?({_NAME})?\s*=\s*["']([^"']*)""", k)
    return F.transform(found, lambda d: F.struct(part(d, 1).alias("prefix"), part(d, 2).alias("uri")))


def bound_to(namespaces: Column, wanted) -> Column:
    """The prefixes whose uri is wanted (uri column -> boolean column)."""
    return F.transform(F.filter(namespaces, lambda x: wanted(x["uri"])), lambda x: x["prefix"])


def is_named(element: Column, name: str, prefixes: Column, declared: Column) -> Column:
    """Elements of that name under one of the prefixes, or under a prefix that is declared nowhere."""
    prefix = F.coalesce(element["_p"], F.lit(""))
    return (element["_n"] == name) & (F.array_contains(prefixes, prefix) | ~F.array_contains(declared, prefix))


def first_named(found: Column, name: str) -> Column:
    """The first element of that name in an array of elements."""
    return F.get(F.filter(found, lambda x: x["_n"] == name), F.lit(0))
