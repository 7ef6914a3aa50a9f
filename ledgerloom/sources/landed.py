"""Readers of landed regulator files and tables. Downloading is not part of the library.

Every reader takes either paths for Spark's readers or a table that holds the files' content, and returns a
lazy DataFrame of built-in expressions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import accession_to_long, filer_of, nan_to_null, taxonomy_version, to_number
from ..schemas import POLICY
from . import markup

# Fixed values of the inputs.
DEI_TAGS = ("EntityCommonStockSharesOutstanding", "EntityPublicFloat")
ELEMENT_TYPES = ("xbrli:monetaryItemType", "xbrli:sharesItemType")
STATEMENTS = ("scf-indir", "sfp-cls", "soi", "sheci", "soc")
TAXONOMY_YEARS = (2008, 2009, *range(2011, 2026))

_ITEM = "array<struct<end: string, accn: string, val: double, form: string, start: string>>"
COMPANY_FACTS = f"cik long, facts map<string, map<string, struct<units: map<string, {_ITEM}>>>>"
BULK_SUBMISSIONS = "cik string, sic string, filings struct<recent: struct<accessionNumber: array<string>, form: array<string>, reportDate: array<string>, acceptanceDateTime: array<string>, primaryDocument: array<string>>>"
SUB_TXT = ("adsh", "cik", "sic", "form", "period", "accepted", "instance")
#: Companies up to this number are named in the scan's filter; of more, all files are read and joined.
NAMED_FILES = 50_000
#: Headers of tab-separated files up to this number are broadcast.
BROADCAST_FILES = 100_000


def whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, content) of each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def company_files(spark: SparkSession, path: str | list[str], ciks: DataFrame | None = None) -> DataFrame:
    """(path, content) of the files named after companies, CIK and ten digits; only those of `ciks` (cik) if given.

    The names go into the scan's filter, so other files are left out when files are listed and are never opened.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))
    if ciks is None:
        return files.drop("file")
    names = ciks.where("cik is not null").select(F.format_string("CIK%010d.json", F.col("cik").cast("long")).alias("file")).distinct()
    if names.limit(NAMED_FILES + 1).count() <= NAMED_FILES:
        return files.where(F.col("file").isin([r["file"] for r in names.collect()])).drop("file")
    return files.join(names, "file", "left_semi").drop("file")


def tsv(spark: SparkSession, path: str | list[str], columns: Iterable[str]) -> DataFrame:
    """The named columns of tab-separated files with headers, as strings, and the path."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    return tsv_lines(lines, columns)


def tsv_lines(lines: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns of the lines (path, line) of tab-separated files, as strings, and the path. Every file has a header of its own, in its own order of columns.

    A header is a line that has all the names; an empty or missing field is null.
    """
    columns = list(columns)
    fields = F.split("line", "\t")
    is_header = F.forall(F.array(*[F.lit(c) for c in columns]), lambda c: F.array_contains(fields, c))
    heads = lines.where(is_header).groupBy("path").agg(F.min("line").alias("__head"))
    heads = heads.select("path", *[F.array_position(F.split("__head", "\t"), c).cast("int").alias(f"__{c}") for c in columns])
    few = F.broadcast(heads) if heads.count() <= BROADCAST_FILES else heads
    return lines.where(~is_header).join(few, "path").select(*[F.nullif(F.get(fields, F.col(f"__{c}") - 1), F.lit("")).alias(c) for c in columns], "path")


def read_ticker_map(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, cik) from a headerless TSV; one ticker per company, the alphabetically first."""
    return first_ticker(spark.read.csv(path, sep="\t", schema="ticker string, cik long"))


def first_ticker(rows: DataFrame) -> DataFrame:
    return rows.where("ticker is not null").groupBy("cik").agg(F.min("ticker").alias("ticker")).select("ticker", "cik")


def discover_periods(pages: DataFrame, *, text_col: str = "html", pattern: str = r"/(\d{4}q[1-4])\.zip") -> DataFrame:
    """Distinct (year, quarter) of the archives that a listing page links to."""
    found = pages.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(1))).alias("p")).distinct()
    return found.select(F.split("p", "q")[0].cast("int").alias("year"), F.split("p", "q")[1].cast("int").alias("quarter")).orderBy("year", "quarter")


def tag_universe_of(elements: DataFrame) -> DataFrame:
    """Distinct tags of concrete money and share elements (name, type, abstract), and two tags of the filer's own."""
    own = elements.sparkSession.createDataFrame([(t,) for t in DEI_TAGS], "tag string")
    return elements.where(F.col("type").isin(*ELEMENT_TYPES) & F.col("abstract").isNull()).select(F.col("name").alias("tag")).union(own).distinct()


def parse_tag_universe(docs: DataFrame) -> DataFrame:
    """tag_universe_of the elements that schema documents (content) declare, of any number of years."""
    each = markup.parsed(docs, 1, ("name", "type", "abstract")).select(F.explode("e").alias("e"))
    return tag_universe_of(each.where("e._n = 'element'").select(F.col("e._name").alias("name"), F.col("e._type").alias("type"), F.col("e._abstract").alias("abstract")))


def read_tag_universe(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_tag_universe(whole_files(spark, path))


def parse_company_facts(docs: DataFrame, tags: DataFrame | None = None, ciks: DataFrame | None = None) -> DataFrame:
    """Facts from company-facts JSON (column content): units USD and shares, annual and quarterly forms, known tags.

    A fact without a start is an instant; starts before 1900 become 1900-01-01.
    """
    parsed = docs.select(F.from_json("content", COMPANY_FACTS).alias("d")).select("d.cik", "d.facts")
    if ciks is not None:
        parsed = parsed.join(ciks.select("cik").distinct(), "cik", "left_semi")
    named = parsed.select("cik", F.explode("facts").alias("taxonomy", "tags")).where(F.col("taxonomy").isin("us-gaap", "dei")).select("cik", "taxonomy", F.explode("tags").alias("tag", "body"))
    named = named.where((F.col("taxonomy") == "us-gaap") | F.col("tag").isin(*DEI_TAGS))
    if tags is not None:
        named = named.join(tags.select("tag").distinct(), "tag", "left_semi")
    items = named.select("tag", F.explode("body.units").alias("unit", "items")).where(F.col("unit").isin("USD", "shares")).select("tag", F.inline("items")).where(F.col("form").isin(*POLICY.forms))
    end = F.col("end").cast("date")
    start = F.coalesce(F.col("start").cast("date"), end)
    return items.select(accession_to_long(F.col("accn")).alias("adsh"), "tag", F.greatest(start, F.lit("1900-01-01").cast("date")).alias("start"), end.alias("end"), nan_to_null(F.col("val")).alias("value"))


def read_company_facts(spark: SparkSession, path: str | list[str], tags: DataFrame | None = None, ciks: DataFrame | None = None) -> DataFrame:
    """Facts from files named after companies; with `ciks`, only their files are read."""
    return parse_company_facts(company_files(spark, path, ciks), tags)


def parse_bulk_submissions(docs: DataFrame, ciks: DataFrame | None = None) -> DataFrame:
    """(adsh, cik, sic, form, period, accepted, file) from bulk metadata JSON (column content); files without recent filings give no rows."""
    d = docs.select(F.from_json("content", BULK_SUBMISSIONS).alias("d")).select(F.col("d.cik").cast("long").alias("cik"), F.coalesce(F.col("d.sic").try_cast("long"), F.lit(0)).alias("sic"), "d.filings.recent")
    if ciks is not None:
        d = d.join(ciks.select("cik").distinct(), "cik", "left_semi")
    each = d.select("cik", "sic", F.inline(F.arrays_zip(*[F.col(f"recent.{c}") for c in ("accessionNumber", "form", "reportDate", "acceptanceDateTime", "primaryDocument")])))
    return each.where(F.col("form").isin(*POLICY.forms)).select(
        accession_to_long(F.col("accessionNumber")).alias("adsh"), "cik", "sic", "form", F.col("reportDate").try_cast("date").alias("period"),
        F.replace(F.col("acceptanceDateTime"), F.lit(".000Z"), F.lit("")).try_cast("timestamp_ntz").alias("accepted"), F.col("primaryDocument").alias("file"),
    )


def read_bulk_submissions(spark: SparkSession, path: str | list[str], ciks: DataFrame | None = None) -> DataFrame:
    """Metadata from files named after companies; with `ciks`, only their files are read."""
    return parse_bulk_submissions(company_files(spark, path, ciks))


def join_fsd(sub: DataFrame, num: DataFrame, ciks: DataFrame | None = None, *, by: tuple[str, ...] = ()) -> DataFrame:
    """Quarterly metadata rows (columns SUB_TXT) with the us-gaap years in num (adsh, version); several years give several rows.

    `by`: columns that both tables have and that must agree besides adsh.
    """
    rows = sub.where(F.col("form").isin(*POLICY.forms) & F.col("period").isNotNull()).withColumn("cik", F.col("cik").cast("long"))
    if ciks is not None:
        rows = rows.join(ciks.select("cik").distinct(), "cik", "left_semi")
    years = num.where(F.col("version").startswith("us-gaap")).select(accession_to_long(F.col("adsh")).alias("adsh"), F.substring(F.split("version", "/")[1], 1, 4).cast("int").alias("version"), *by).distinct()
    rows = rows.select(
        accession_to_long(F.col("adsh")).alias("adsh"), "cik", F.coalesce(F.col("sic").try_cast("double").cast("long"), F.lit(0)).alias("sic"), "form",
        F.to_date(F.col("period").cast("double").cast("long").cast("string"), "yyyyMMdd").alias("period"), F.col("accepted").cast("timestamp_ntz").alias("accepted"), F.col("instance").alias("file"), *by,
    )
    return rows.join(years, ["adsh", *by], "left").withColumn("version", F.coalesce("version", F.lit(0)))


def read_fsd_submissions(spark: SparkSession, sub_path: str | list[str], num_path: str | list[str], ciks: DataFrame | None = None) -> DataFrame:
    """One quarter's sub.txt and num.txt."""
    return join_fsd(tsv(spark, sub_path, SUB_TXT), tsv(spark, num_path, ("adsh", "version")), ciks).select("adsh", "cik", "sic", "form", "period", "accepted", "file", "version")


def combine_quarters(sub: DataFrame, num: DataFrame, ciks: DataFrame | None = None, *, keep_all: bool = False) -> DataFrame:
    """join_fsd of many quarters at once: sub (SUB_TXT, path) and num (adsh, version, path), the quarter from the name of a file's folder.

    A filing's years come from its own quarter. Of a filing in several quarters the rows of the last one count, or all with keep_all.
    """
    quarter = F.regexp_extract("path", r"(\d{4}q[1-4])", 1).alias("quarter")
    rows = join_fsd(sub.select(*SUB_TXT, quarter), num.select("adsh", "version", quarter), ciks, by=("quarter",))
    if keep_all:
        return rows
    last = F.max("quarter").over(Window.partitionBy("adsh"))
    return rows.withColumn("__last", last).where("quarter = __last").drop("__last")


def read_fsd_many(spark: SparkSession, folders: list[str], ciks: DataFrame | None = None, *, keep_all: bool = False) -> DataFrame:
    """combine_quarters of the sub.txt and num.txt in folders that are named after quarters: one scan of each kind."""
    return combine_quarters(tsv(spark, [f"{p}/sub.txt" for p in folders], SUB_TXT), tsv(spark, [f"{p}/num.txt" for p in folders], ("adsh", "version")), ciks, keep_all=keep_all)


def read_xbrl_instances(docs: DataFrame, tags: DataFrame | None = None, summaries: DataFrame | None = None) -> DataFrame:
    """Facts from instance documents (adsh, cik, content): contexts of the filing's own company, units of money and shares.

    Facts are the elements below the root in a us-gaap or dei namespace, whatever prefix is bound to it; with `summaries`
    (adsh, namespaces; read_filing_summary) in one of the filing's own namespaces. A prefix that is declared nowhere counts as
    its usual namespace. A unit is a measure of its own: quotients of units are none. A fact without text (nil) is 0, a value that is no number is
    dropped. Dimensional contexts are not told apart; facts that differ only by dimension contradict each other and are removed later.
    A document that is no XML or null has no facts. Of contexts with one id the smallest counts. One scan, without shuffles.
    """
    own, kept = docs.select("adsh", F.col("cik").cast("long").alias("cik"), "content"), []
    if summaries is not None:
        own, kept = own.join(summaries.groupBy("adsh").agg(F.flatten(F.collect_list("namespaces")).alias("known")), "adsh"), ["known"]
    own = markup.once(own, "adsh", "cik", "content", *kept, spaces=markup.declared_namespaces(F.col("content")))
    declared = F.transform("spaces", lambda x: x["prefix"])
    usual = F.filter(F.array(F.lit("us-gaap"), F.lit("dei")), lambda p: ~F.array_contains(declared, p))
    if summaries is None:
        facts = F.concat(markup.bound_to(F.col("spaces"), lambda uri: uri.contains("/us-gaap/") | uri.contains("/dei/")), usual)
    else:
        facts = markup.bound_to(F.col("spaces"), lambda uri: F.array_contains("known", uri))
    parsed = markup.elements(F.col("content"), 3, ("id", "contextRef", "unitRef"))
    prefixed = markup.once(own, "adsh", "cik", e=parsed, declared=declared, facts=facts, instance=markup.bound_to(F.col("spaces"), lambda uri: uri == markup.INSTANCE))

    named = lambda x, name: markup.is_named(x, name, F.col("instance"), F.col("declared"))
    text = lambda x: F.nullif(F.trim(x["_VALUE"]), F.lit(""))
    entity = lambda c: text(markup.first_named(markup.first_named(c["e"], "entity")["e"], "identifier")).try_cast("long")

    def day(context, name: str):
        period = markup.first_named(context["e"], "period")["e"]
        return F.coalesce(text(markup.first_named(period, name)), text(markup.first_named(period, "instant"))).try_cast("date")

    contexts = F.transform(F.filter("e", lambda x: named(x, "context") & (entity(x) == F.col("cik"))), lambda x: F.struct(x["_id"].alias("id"), day(x, "startDate").alias("start"), day(x, "endDate").alias("end")))
    measure = lambda u: text(markup.first_named(u["e"], "measure"))
    units = F.transform(F.filter("e", lambda x: named(x, "unit") & measure(x).rlike("^(.*:)?(USD|shares)$")), lambda x: x["_id"])
    reported = F.filter("e", lambda x: F.array_contains(F.col("facts"), F.coalesce(x["_p"], F.lit(""))))
    held = markup.once(prefixed, "adsh", units=units, sorted=F.array_sort(F.filter(contexts, lambda c: c["id"].isNotNull())), e=reported)
    first = F.filter("sorted", lambda c, i: (i == 0) | (F.get(F.col("sorted"), i - 1)["id"] != c["id"]))
    by_id = F.map_from_entries(F.transform(first, lambda c: F.struct(c["id"], F.struct(c["start"].alias("start"), c["end"].alias("end")).alias("days"))))
    held = markup.once(held, "adsh", "units", "e", contexts=by_id)
    each = held.select("adsh", "units", "contexts", F.explode("e").alias("f")).where(F.array_contains("units", F.col("f._unitRef")))
    each = each.select("adsh", F.col("f._n").alias("tag"), F.try_element_at("contexts", F.col("f._contextRef")).alias("c"), text(F.col("f")).alias("text")).where("c is not null")
    out = each.select("adsh", "tag", "c.start", "c.end", F.coalesce(to_number(F.col("text")), F.when(F.col("text").isNull(), F.lit(0.0))).alias("value")).where("value is not null")
    return out if tags is None else out.join(tags.select("tag").distinct(), "tag", "left_semi").select("adsh", "tag", "start", "end", "value")


def read_filing_summary(docs: DataFrame) -> DataFrame:
    """(adsh, file, namespaces) from filing summaries (adsh, content): the first input file of an allowed type, and the dei and us-gaap namespaces."""
    parsed = markup.parsed(docs, 2, ("doctype",), "adsh")
    inside = lambda holder, name: F.filter(F.flatten(F.transform(F.filter("e", lambda x: x["_n"] == holder), lambda x: F.coalesce(x["e"], F.array()))), lambda x: x["_n"] == name)
    allowed = F.filter(inside("InputFiles", "File"), lambda f: f["_doctype"].isin(*POLICY.forms))
    spaces = F.filter(F.transform(inside("BaseTaxonomies", "BaseTaxonomy"), lambda x: F.trim(x["_VALUE"])), lambda uri: uri.contains("/us-gaap/") | uri.contains("/dei/"))
    return parsed.select("adsh", F.trim(F.get(allowed, F.lit(0))["_VALUE"]).alias("file"), F.coalesce(spaces, F.array()).cast("array<string>").alias("namespaces"))


def scan_taxonomy_version(sub: DataFrame, documents: DataFrame) -> DataFrame:
    """Submissions whose version is the first us-gaap year in their document (adsh, text), 0 without one."""
    years = documents.groupBy("adsh").agg(F.max(taxonomy_version(F.col("text"))).alias("__v"))
    return sub.drop("version").join(years, "adsh", "left").withColumn("version", F.coalesce("__v", F.lit(0))).drop("__v")


def lookup_missing_submissions(missing: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata rows of the missing filings, looked for at the filer that their accession number names."""
    wanted = missing.select("adsh", filer_of(F.col("adsh")).alias("cik")).distinct()
    return metadata.join(wanted.select("cik").distinct(), "cik", "left_semi").join(wanted.select("adsh"), "adsh", "left_semi")


def clean_arcs(raw: DataFrame) -> DataFrame:
    """Arcs (path, from, to, weight as text) with bare names, number weights, and statement and year from the path."""
    bare = lambda c: F.regexp_replace(c, "loc_|http://fasb.org/us-gaap/role/statement/|http://xbrl.us/us-gaap/role/statement/", "")
    # the two role prefixes are fixed values of the inputs
    statement = F.regexp_extract("path", rf"-({'|'.join(STATEMENTS)})-", 1)
    return raw.select(F.regexp_extract("path", r"(20\d{2})", 1).try_cast("int").alias("version"), statement.alias("statement"), bare("from").alias("from"), bare("to").alias("to"), F.col("weight").cast("double").alias("weight"))


def parse_calculation_arcs(docs: DataFrame) -> DataFrame:
    """Arcs (version, statement, from, to, weight) from calculation linkbases (path, content), below the root or in its links."""
    arc = lambda found: F.transform(F.filter(found, lambda x: x["_n"] == "calculationArc"), lambda x: F.struct(x["_from"].alias("from"), x["_to"].alias("to"), x["_weight"].alias("weight")))
    parsed = markup.parsed(docs, 2, ("from", "to", "weight"), "path")
    inner = F.flatten(F.transform("e", lambda x: F.coalesce(x["e"], F.array())))
    return clean_arcs(parsed.select("path", F.inline(F.concat(arc(F.col("e")), arc(inner)))))


def calculation_arcs(docs: DataFrame) -> DataFrame:
    """(version, statement, seq, from, to, weight) from calculation linkbases (path, content) of any number of years and statements, in one plan."""
    from ..operators.arcs import assign_arc_sequence

    return assign_arc_sequence(parse_calculation_arcs(docs)).select("version", "statement", "seq", "from", "to", "weight")


def read_calculation_arcs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Arcs with seq from calculation linkbases; many years and statements are one scan of many paths."""
    return calculation_arcs(whole_files(spark, path))


def read_calculation_arcs_many(spark: SparkSession, path: str | list[str], *, years: Iterable[int] = TAXONOMY_YEARS, statements: Iterable[str] = STATEMENTS) -> DataFrame:
    """Arcs with seq of the calculation linkbases under a folder that are of these years and statements, by their names; other files are not opened."""
    wanted = rf"-({'|'.join(statements)})-cal-({'|'.join(str(y) for y in years)})[^/]*$"
    return calculation_arcs(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).where(F.col("_metadata.file_name").rlike(wanted)).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))


def backfill_missing_facts(facts: DataFrame, sub: DataFrame, instances: DataFrame, tags: DataFrame | None = None, summaries: DataFrame | None = None) -> DataFrame:
    """Facts and the instance facts (instances: adsh, content; summaries as in read_xbrl_instances) of filings without any."""
    from ..operators.submissions import reports_without_facts

    bare = reports_without_facts(sub, facts).select("adsh", "cik").join(instances, "adsh")
    return facts.unionByName(read_xbrl_instances(bare, tags, summaries))
