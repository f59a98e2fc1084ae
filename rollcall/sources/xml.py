"""XML scans: files by row tag, or XML text already sitting in a column."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators.small_tables import BROADCAST_BYTES, fits_broadcast, materialise
from rollcall.schemas import (
    CORRUPT_COLUMN, FEED_ENTITY, LIST_ENTITY, LIST_INDIVIDUAL, XML_OPTIONS,
)


def _options(row_tag: str, schema: str) -> dict:
    extra = {"columnNameOfCorruptRecord": CORRUPT_COLUMN} if CORRUPT_COLUMN in schema else {}
    return {**XML_OPTIONS, "rowTag": row_tag, **extra}


def with_corrupt(schema: str) -> str:
    return f"{schema}, {CORRUPT_COLUMN} string"


def parse_column(df: DataFrame, xml: str, schema: str, row_tag: str, *keep: str) -> DataFrame:
    """Parse one record per row out of a text column.

    ``inline`` keeps the parse below every later filter, so a pushed-down
    predicate reads the parsed field and never parses a second time.
    """
    record = F.from_xml(F.col(xml), schema, _options(row_tag, schema))
    return df.select(*keep, F.inline(F.array(record)))


LIST_FILE = "list_file"


def _read(spark: SparkSession, path, schema: str, row_tag: str) -> DataFrame:
    records = spark.read.schema(schema).options(**_options(row_tag, schema)).xml(path)
    return records.select("*", F.col("_metadata.file_path").alias(LIST_FILE))


#: Comments and CDATA sections, whole; and what is left of ones that a piece cuts.
_SECTION = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_EDGE = r"<!--|-->|<!\[CDATA\[|\]\]>"
COMMENT, DATA = ("<!--", "-->"), ("<![CDATA[", "]]>")
_MESSAGE = "comments and CDATA sections that hold each other's ends: read with splittable=False"


def _close_tag(spark: SparkSession, path, row_tag: str) -> str:
    """How the first closing tag of a record is written; prefixes and blanks are possible."""
    tags = spark.read.option("lineSep", ">").text(path).filter(F.col("value").contains(row_tag))
    found = tags.select(F.regexp_extract("value", rf"</(?:[\w.-]+:)?{row_tag}\s*\z", 0).alias("tag")).filter("tag != ''").first()
    return f"{found.tag}>" if found else f"</{row_tag}>"


def _edges(value: Column) -> Column:
    """Ends of sections in a piece whose other end lies in another piece, in order."""
    some = reduce(lambda a, b: a | b, [value.contains(e) for e in (*COMMENT, *DATA)])
    cut = F.regexp_extract_all(F.regexp_replace(value, _SECTION, ""), F.lit(_EDGE), F.lit(0))
    return F.when(some, cut).otherwise(F.array().cast("array<string>"))


def _cut_sections(pieces: DataFrame) -> DataFrame:
    """``list_file``, ``first`` and ``last`` places of the pieces to be joined, as a section goes on between them.

    Only pieces that cut a section are looked at. A section is open behind a piece if the
    last edge of its kind opens one; edges of the other kind within it are not followed.
    """
    order = W.partitionBy(LIST_FILE).orderBy("place")
    upto, before = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    events = pieces.select(LIST_FILE, "place", _edges(F.col("value")).alias("edges")).filter(F.size("edges") > 0)
    for name, (opens, closes) in (("comment", COMMENT), ("data", DATA)):
        own = F.filter("edges", lambda e: e.isin(opens, closes))
        events = events.withColumn(f"{name}_edge", F.try_element_at(own, F.lit(-1)) == opens)
        for when, span in (("after", upto), ("before", before)):
            events = events.withColumn(f"{name}_{when}", F.coalesce(F.last(f"{name}_edge", ignorenulls=True).over(span), F.lit(False)))
    odd = (F.col("comment_edge").isNotNull() & (F.col("data_edge").isNotNull() | F.col("data_before"))) | (
        F.col("data_edge").isNotNull() & F.col("comment_before"))
    known = F.when(odd, F.raise_error(F.lit(_MESSAGE)).cast("boolean")).otherwise(F.col("comment_after") | F.col("data_after"))
    events = events.withColumn("open", known).withColumn("open_before", F.col("comment_before") | F.col("data_before"))
    events = events.filter("open OR open_before").withColumn("run", F.sum((~F.col("open_before")).cast("int")).over(upto))
    runs = events.groupBy(LIST_FILE, "run").agg(F.min("place").alias("first"), F.max("place").alias("end"), F.max_by("open", "place").alias("open"))
    # A section that nothing closes lasts to the end of its file.
    return runs.select(F.col(LIST_FILE).alias("_file"), "first", F.when(~F.col("open"), F.col("end")).alias("last"))


def _whole_pieces(spark: SparkSession, path, close: str) -> DataFrame:
    """``list_file`` and ``value``: the text between closing tags, those inside comments and CDATA left out.

    Few files have sections that hold closing tags, so these are looked for first, and only
    then are pieces numbered and joined; no other piece is moved.
    """
    pieces = spark.read.option("lineSep", close).text(path).select(
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("place"),
        "value", F.col("_metadata.file_path").alias(LIST_FILE))
    if materialise(_cut_sections(pieces)).isEmpty():
        return pieces.select(LIST_FILE, "value")
    pieces = materialise(pieces)
    runs = materialise(_cut_sections(pieces))
    held = F.broadcast(runs) if fits_broadcast(runs, BROADCAST_BYTES) else runs
    within = (F.col(LIST_FILE) == F.col("_file")) & (F.col("place") >= F.col("first")) & (F.col("last").isNull() | (F.col("place") <= F.col("last")))
    placed = pieces.join(held, within, "left")
    parts = F.array_sort(F.collect_list(F.struct("place", "value")))
    joined = placed.filter("first IS NOT NULL").groupBy(LIST_FILE, "first").agg(parts.alias("parts"))
    texts = F.array_join(F.transform("parts", lambda p: p["value"]), close)
    return placed.filter("first IS NULL").select(LIST_FILE, "value").union(joined.select(LIST_FILE, texts.alias("value")))


def _plain(value: Column) -> Column:
    """The same XML without comments, and with CDATA as escaped text, so that every tag in it is one."""
    bare = F.regexp_replace(value, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1")
    escaped = lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    turned = F.transform(F.split(bare, r"<!\[CDATA\[|\]\]>"), lambda t, i: F.when(i % 2 == 1, escaped(t)).otherwise(t))
    return F.when(value.contains("<!"), F.array_join(turned, "")).otherwise(value)


def _read_split(spark: SparkSession, path, schema: str, row_tag: str) -> DataFrame:
    """The same records from files too large for one task.

    The XML source reads a file in one task. The text source splits files, and with the
    closing tag as its line end a piece holds self-closed records, and then one other
    record at most. The tag is taken as the first one is written; others, with a prefix or
    blanks, part a piece further.
    """
    name = rf"(?:[\w.-]+:)?{row_tag}"
    pieces = _whole_pieces(spark, path, _close_tag(spark, path, row_tag)).select(LIST_FILE, _plain(F.col("value")).alias("value"))
    start = rf"(?s)^(.*)(<{name}(?:\s(?:[^>]*[^/>])?)?>.*)$"

    def records(piece: Column) -> Column:
        last = F.regexp_extract(piece, start, 2)
        head = F.when(last == "", piece).otherwise(F.regexp_extract(piece, start, 1))
        closed = F.regexp_extract_all(head, F.lit(rf"<{name}(?:\s[^>]*)?/>"), F.lit(0))
        return F.when(last == "", closed).otherwise(F.array_append(closed, F.concat(F.regexp_replace(last, r"^<[\w.-]+:", "<"), F.lit(f"</{row_tag}>"))))

    found = F.flatten(F.transform(F.split("value", rf"</{name}\s*>"), records))
    return parse_column(pieces.select(F.explode(found).alias("record"), LIST_FILE), "record", schema, row_tag, LIST_FILE)


def read_records(
    spark: SparkSession, path, schema: str, row_tag: str,
    splittable: bool = False, quarantine: bool = False, with_file: bool = False,
) -> DataFrame:
    """Records by row tag; ``with_file`` adds the path each was read from as ``list_file``."""
    schema = with_corrupt(schema) if quarantine else schema
    reader = _read_split if splittable else _read
    records = reader(spark, path, schema, row_tag)
    return records if with_file else records.drop(LIST_FILE)


def read_feed(spark: SparkSession, path, **how) -> DataFrame:
    return read_records(spark, path, FEED_ENTITY, "entity", **how)


def read_list_individuals(spark: SparkSession, path, **how) -> DataFrame:
    return read_records(spark, path, LIST_INDIVIDUAL, "INDIVIDUAL", **how)


def read_list_entities(spark: SparkSession, path, **how) -> DataFrame:
    return read_records(spark, path, LIST_ENTITY, "ENTITY", **how)


def read_generation_stamps(spark: SparkSession, path) -> DataFrame:
    """``list_file``, ``stamp``: the first ``dateGenerated`` of every file that has one.

    Lists carry it on their root element, whatever its name. Only opening tags with
    the attribute are looked at, so the scan is a text scan with a substring test, not
    an XML parse of a whole list in one record.
    """
    attribute = r"(?s)<[^\s<>!?/][^<]*\sdateGenerated\s*=\s*[\"']([^\"']*)"
    tags = spark.read.option("lineSep", ">").text(path).filter(
        F.col("value").contains("dateGenerated") & ~F.col("value").contains("<!--")
    ).select(
        F.col("_metadata.file_path").alias(LIST_FILE),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.nullif(F.regexp_extract("value", attribute, 1), F.lit("")).alias("stamp"),
    )
    first = F.min_by("stamp", F.struct("block", "at"))
    return tags.filter("stamp IS NOT NULL").groupBy(LIST_FILE).agg(first.alias("stamp"))


def split_corrupt(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, texts of the records that failed to parse)."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return records.filter(~bad).drop(CORRUPT_COLUMN), records.filter(bad).select(CORRUPT_COLUMN)
