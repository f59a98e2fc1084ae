"""The jobs a user runs: land a list, encode documents, consolidate, report.

Every job writes its table first and reports from what it wrote, so nothing is
parsed twice. Output goes to a directory of its own, never among the inputs.
"""

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.dates import generation_date
from rollcall.operators import answers, consolidate, documents, feed, full_list, reports
from rollcall.operators.small_tables import BROADCAST_BYTES, fits_broadcast, materialise
from rollcall.schemas import CORRUPT_COLUMN, FEED_CONTRACT, LIST_CONTRACT, strings
from rollcall.sources import documents as document_files
from rollcall.sources import list_csv, xml
from rollcall.sources.readable import readable


def _written(spark: SparkSession, path: str, schema) -> DataFrame:
    options = {**list_csv.CSV_READ, "header": "true"}
    return spark.read.schema(schema).options(**options).csv(path)


def _write_unless_empty(df: DataFrame, path: str) -> str | None:
    """Parse once into a table, so that asking for emptiness parses nothing again."""
    ready = materialise(df)
    if ready.isEmpty():
        return None
    list_csv.write_list_csv(ready, path)
    return path


LANDING_REJECTS = "file string, reason string, record string"


def _set_aside(rejects: DataFrame, out_dir: str, name: str) -> None:
    """Broken records and unreadable files, with their files and texts; nothing if there are none."""
    ready = materialise(rejects)
    if not ready.isEmpty():
        ready.write.mode("overwrite").json(f"{out_dir}/rejects/{name}")


def landing_rejects(spark: SparkSession, out_dir: str, name: str = "*") -> DataFrame:
    """``file``, ``reason`` and ``record`` of all that the landing jobs set aside in ``out_dir``, or one of them by its export's name.

    An unreadable file has no record.
    """
    try:
        return spark.read.schema(LANDING_REJECTS).json(f"{out_dir}/rejects/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LANDING_REJECTS)


def _parsed(spark: SparkSession, source, read, splittable: bool = True, **how) -> tuple[DataFrame, DataFrame]:
    """(good records with their ``list_file``, rejects), from a table into which every record is parsed once.

    Records are cut out before they are parsed, so a broken one is set aside alone. Spark's own
    XML source (``splittable=False``) gives up a file at its first broken record.
    """
    records = materialise(read(spark, source, quarantine=True, with_file=True, splittable=splittable, **how))
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    rejects = records.filter(bad).select(F.col(xml.LIST_FILE).alias("file"), F.lit("not well-formed").alias("reason"), F.col(CORRUPT_COLUMN).alias("record"))
    return records.filter(~bad).drop(CORRUPT_COLUMN), rejects


def land_feed(spark: SparkSession, source, out_dir: str, day: str, **how) -> DataFrame | None:
    """Delta-feed files to ``sanctions_cleaned_<day>.csv``; None when empty.

    Broken records and unreadable files do not stop the others; :func:`landing_rejects` names them.
    """
    name = f"{fv.CLEANED_PREFIX}{day}.csv"
    files, unread = readable(spark, source)
    if not files:
        _set_aside(unread, out_dir, name)
        return None
    good, broken = _parsed(spark, files, xml.read_feed, **how)
    path = _write_unless_empty(feed.flatten_feed(good), f"{out_dir}/{name}")
    _set_aside(broken.unionByName(unread, allowMissingColumns=True), out_dir, name)
    return _written(spark, path, FEED_CONTRACT) if path else None


def _recent(spark: SparkSession, source, today: Column):
    """A filter of records by the generation day of their list."""
    stamps = materialise(xml.read_generation_stamps(spark, source))
    # A row per file; beyond the checked size the join shuffles.
    known = F.broadcast(stamps) if fits_broadcast(stamps, BROADCAST_BYTES) else stamps

    def recent(records: DataFrame) -> DataFrame:
        dated = records.join(known, xml.LIST_FILE, "left")
        day = generation_date(F.col("stamp"), today)
        return full_list.recent_only(dated, day).drop(xml.LIST_FILE, "stamp")

    return recent


def recent_list(
    spark: SparkSession, source, today: Column, **how
) -> tuple[DataFrame, DataFrame]:
    """(individuals, entities) listed on their list's generation day or just before.

    Every file is held against its own date, and against ``today`` if it has none.
    """
    recent = _recent(spark, source, today)
    people = recent(xml.read_list_individuals(spark, source, with_file=True, **how))
    groups = recent(xml.read_list_entities(spark, source, with_file=True, **how))
    return full_list.flatten_individuals(people), full_list.flatten_entities(groups)


def land_full_list(
    spark: SparkSession, source, out_dir: str, stamp: str, today: Column, **how
) -> list[DataFrame]:
    """The recent listings to one export each for individuals and entities.

    Broken records and unreadable files do not stop the others; :func:`landing_rejects` names them.
    """
    name = f"{fv.CLEANED_PREFIX}{stamp}.csv"
    files, unread = readable(spark, source)
    if not files:
        _set_aside(unread, out_dir, name)
        return []
    recent = _recent(spark, files, today)
    people, broken_people = _parsed(spark, files, xml.read_list_individuals, **how)
    groups, broken_groups = _parsed(spark, files, xml.read_list_entities, **how)
    paths = [
        _write_unless_empty(full_list.flatten_individuals(recent(people)), f"{out_dir}/{name}"),
        _write_unless_empty(full_list.flatten_entities(recent(groups)), f"{out_dir}/{fv.CLEANED_PREFIX}entities_{stamp}.csv"),
    ]
    _set_aside(broken_people.union(broken_groups).unionByName(unread, allowMissingColumns=True), out_dir, name)
    return [_written(spark, p, LIST_CONTRACT) for p in paths if p]


def encode_directory(spark: SparkSession, source: str, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """Encode a directory of documents: (status per file, batch summary)."""
    encoded = documents.encode_files(document_files.read_documents(spark, source))
    written = document_files.write_encoded(encoded, out_dir)
    return written.drop("base64_content"), reports.batch_summary(written)


def land_answers(
    spark: SparkSession, replies: DataFrame, answer: str, source: str, out_dir: str, stamp: str
) -> DataFrame:
    """Save the cleaned answers as list exports, and return their rows as tagged list rows.

    ``replies`` has one answer text per document, ``source`` names the document.
    Each document becomes the export ``sanctions_from_<stem>_<stamp>.csv``, a row of
    the table of answers in ``out_dir``, which a consolidation of that directory
    finds; so any number of answers lands in as many files as there are tasks. Landing
    the same document again under the same stamp replaces its export and leaves all
    others as they are; a null answer lands nothing.
    """
    name = F.regexp_replace(F.col(source), r"\.[^.]*\z", "")
    named = replies.select(
        F.concat(F.lit(fv.REGULATION_PREFIX), name, F.lit(f"_{stamp}.csv")).alias("src_file"),
        answers.strip_fences(F.col(answer)).alias("csv_text"),
    )
    saved = materialise(named)
    list_csv.write_answers(saved.filter("csv_text IS NOT NULL"), out_dir, time.time_ns())
    rows = answers.answer_rows(saved, "csv_text", "src_file", "src_file")
    return consolidate.tag_source(rows.drop("Source_File"), 1, F.col("src_file"), "row_pos")


@dataclass
class Consolidation:
    """What a consolidation leaves behind.

    ``shares`` has the distributions of the result. The other figures are over
    all rows read, duplicates included: ``converted_dates``, and the most
    frequent list labels before and after these are made standard.
    ``rejects`` names the records that were set aside, and their files.
    """

    table: DataFrame
    summary: DataFrame
    converted_dates: DataFrame
    shares: DataFrame
    labels_before: DataFrame
    labels_after: DataFrame
    rejects: DataFrame


def consolidate_directory(
    spark: SparkSession, source: str, out_dir: str, strict: bool = False, splittable: bool = False
) -> Consolidation:
    """All list exports of a directory to one sorted table with its report; ``splittable`` reads large files in blocks."""
    exports = list_csv.list_exports(spark, source)
    if not exports:
        raise FileNotFoundError(f"no list exports in {source}")
    found, bad = list_csv.read_exports(spark, exports, splittable=splittable)
    rows = materialise(found)
    bad.write.options(**list_csv.CSV_WRITE).csv(f"{out_dir}/rejects")
    per_file = materialise(consolidate.file_labels(rows))
    final = consolidate.consolidate(rows, strict=strict, per_file=per_file).drop(*consolidate.ORDER)
    list_csv.write_list_csv(final, f"{out_dir}/consolidated")
    table = _written(spark, f"{out_dir}/consolidated", strings(final.columns))
    kept = materialise(table)
    reports.summary_record(rows, kept).write.option("header", "true").csv(f"{out_dir}/summary")
    summary = spark.read.schema("metric string, item string, n long").option(
        "header", "true"
    ).csv(f"{out_dir}/summary")
    labelled = consolidate.with_labels(rows, per_file)
    standard = consolidate.normalise(labelled, strict)
    return Consolidation(
        table=table,
        summary=summary,
        converted_dates=consolidate.converted_dates(standard),
        shares=reports.distribution(kept, "Type", "Watchlist"),
        labels_before=reports.top_values(labelled, "Watchlist"),
        labels_after=reports.top_values(standard, "Watchlist"),
        rejects=_written(spark, f"{out_dir}/rejects", list_csv.REJECTS),
    )


def consolidate_sources(
    out_dir: str, uploads: int, *sources: tuple[str, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """The interactive job: sources in the order given, deduplicated only.

    Each source is a tag and its rows, with ``row_pos`` giving their order.
    Returns the written data and its four-line summary sheet.
    """
    tagged = [
        consolidate.tag_source(df, rank, tag, "row_pos").withColumn("Source_File", F.lit(tag))
        for rank, (tag, df) in enumerate(sources)
    ]
    spark = tagged[0].sparkSession
    rows = materialise(consolidate.unite(*tagged))
    consolidate.consolidate(rows, normalised=False).write.parquet(f"{out_dir}/data")
    data = spark.read.parquet(f"{out_dir}/data")
    sheet = reports.report_sheet(data, reports.duplicate_count(rows), F.lit(uploads))
    sheet.write.parquet(f"{out_dir}/summary")
    return data, spark.read.parquet(f"{out_dir}/summary")
