"""List exports as CSV: one scan for files whose columns differ."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.csvtext import csv_fields, csv_records, fields_at, places_of, present
from rollcall.operators.consolidate import ROW_POS, SRC_FILE, SRC_RANK
from rollcall.operators.small_tables import join_known, materialise
from rollcall.sources.readable import readable
from rollcall.sources.split_csv import split_records

CSV_READ = {
    "header": "false", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}
CSV_WRITE = {
    "header": "true", "escape": '"', "encoding": "UTF-8", "emptyValue": "", "nullValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",  # blanks stay as they are
}

ALL_COLUMNS = tuple(dict.fromkeys(fv.FEED_COLUMNS + fv.LIST_COLUMNS))
MAX_COLUMNS = 1_000_000
#: The table of landed answers beside the exports of a directory, and its columns.
ANSWERS = "regulation_answers"
ANSWER_TABLE = "src_file string, csv_text string, landed long"
RECORDS = "src_file string, part string, row long, fields array<string>"
REJECTS = "src_file string, part string, record_no long, n_fields int, n_header int, record string, reason string"
_PREFIX = f"(?:{fv.CLEANED_PREFIX}|{fv.REGULATION_PREFIX})"
# The last part of a path that has the name of an export: a file, or a directory of parts,
# which may be the partition of a written table.
EXPORT_NAME = rf"(?:^|/)(?:{SRC_FILE}=)?({_PREFIX}[^/]*)(?:/(?!{_PREFIX})[^/]*)?$"


def _decoded(text: Column) -> Column:
    """A path part without its percent signs; as it is where these are no code."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def export_name(path: Column) -> Column:
    """The export a file belongs to; partition values are encoded once more than paths."""
    name = _decoded(F.regexp_extract(path, EXPORT_NAME, 1))
    return F.when(path.rlike(rf"/{SRC_FILE}={_PREFIX}"), _decoded(name)).otherwise(name)


def scan_records(spark: SparkSession, paths) -> DataFrame:
    """Every record of every file as an array of texts, with its place.

    Headers are records like any other here, so files of all shapes share one
    scan and no schema is inferred. With a schema of one column, Spark keeps
    every wider record as its text, whose fields are then told apart without a
    bound on their number. ``row`` grows along a file and means nothing beyond
    one run of the scan, so the result is to be written before it is compared.
    """
    options = {**CSV_READ, "maxColumns": MAX_COLUMNS, "columnNameOfCorruptRecord": "record"}
    raw = spark.read.schema("only string, record string").options(**options).csv(paths)
    text = F.regexp_replace("record", r"^[\r\n]+|[\r\n]+\z", "")
    part = F.col("_metadata.file_path")
    return raw.select(
        export_name(part).alias(SRC_FILE),
        part.alias("part"),
        F.monotonically_increasing_id().alias("row"),
        F.when(F.col("record").isNull(), F.array(F.coalesce("only", F.lit(""))))
        .otherwise(csv_fields(text)).alias("fields"),
    )


def scan_split(spark: SparkSession, paths) -> DataFrame:
    """The records of :func:`scan_records`, each file read by as many tasks as it has blocks."""
    return split_records(spark, paths).select(
        export_name(F.col("part")).alias(SRC_FILE), "part", "row", csv_fields(F.col("record")).alias("fields"))


def write_answers(answers: DataFrame, directory: str, landed: int) -> None:
    """Add (src_file, csv_text) to the directory's table of answers; of one export the answer landed last counts."""
    answers.select("src_file", "csv_text", F.lit(landed).cast("long").alias("landed")).write.mode("append").parquet(f"{directory}/{ANSWERS}")


def scan_answers(spark: SparkSession, path: str) -> DataFrame:
    """The records of the exports in a table of answers, as of :func:`scan_records`."""
    table = spark.read.schema(ANSWER_TABLE).parquet(path)
    last = materialise(table.groupBy("src_file").agg(F.max("landed").alias("last")))
    texts = join_known(table, last, "src_file", "csv_text").filter("landed = last")
    records = texts.select("src_file", F.posexplode(csv_records(F.col("csv_text"))).alias("row", "record"))
    return records.select(F.col("src_file").alias(SRC_FILE), F.concat(F.lit(f"{path}#"), "src_file").alias("part"), F.col("row").cast("long").alias("row"), csv_fields(F.col("record")).alias("fields"))


def headers(records: DataFrame) -> DataFrame:
    """``part``, ``head_row`` and ``header`` of every file in a written table of records.

    The first row is found among numbers alone; its fields are picked by a filter.
    """
    first = materialise(records.groupBy("part").agg(F.min("row").alias("head_row")))
    heads = join_known(records, first, "part", "row").filter("row = head_row")
    header = F.transform(F.col("fields"), lambda h: F.replace(h, F.lit("\ufeff"), F.lit("")))
    return materialise(heads.select("part", "head_row", header.alias("header")))


def read_exports(spark: SparkSession, paths, columns=ALL_COLUMNS, splittable: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows under ``columns``, matched by header name; rejected records).

    A file is read by one task, or with ``splittable`` by one for each of its blocks.

    Files with nothing but a header add no rows. A record with more fields than
    its file's header is set aside, with its file and its number in it (the
    header is 0), and the file's other records are kept. Fields missing at the
    end of a record are null. A compressed file that cannot be unpacked is set aside
    as a whole, with the reason, and the other files are read.

    The records are written once, and headers, rows and rejects are all read
    from that table, so that nothing depends on how a scan deals out files.
    """
    scan = scan_split if splittable else scan_records
    paths = [paths] if isinstance(paths, str) else list(paths)
    held = [p for p in paths if p.rstrip("/").endswith(f"/{ANSWERS}")]
    files, unread = readable(spark, [p for p in paths if p not in held])
    found = [*([scan(spark, files)] if files else []), *(scan_answers(spark, p) for p in held)]
    records = materialise(reduce(DataFrame.unionByName, found)) if found else spark.createDataFrame([], RECORDS)
    known = headers(records).select(
        "part", "head_row", F.size("header").alias("n_header"),
        places_of(F.col("header"), columns).alias("places"),
    )
    body = join_known(records, known, "part", "row").filter("row > head_row")
    wide = F.size("fields") > F.col("n_header")
    family = F.when(F.col(SRC_FILE).startswith(fv.CLEANED_PREFIX), 0).otherwise(1)
    rows = body.filter(~wide).withColumn("fields", present(F.col("fields"))).select(
        *fields_at("fields", "places", columns), family.alias(SRC_RANK), SRC_FILE,
        F.struct("part", "row").alias(ROW_POS),
    )
    rejects = body.filter(wide).select(
        SRC_FILE, "part", (F.col("row") - F.col("head_row")).alias("record_no"),
        F.size("fields").alias("n_fields"), "n_header",
        F.to_json("fields").alias("record"), F.lit("more fields than the header").alias("reason"),
    )
    files = unread.select(export_name(F.col("file")).alias(SRC_FILE), F.col("file").alias("part"), "reason")
    return rows, rejects.unionByName(files, allowMissingColumns=True)


def read_list_csv(spark: SparkSession, paths, columns=ALL_COLUMNS, splittable: bool = False) -> DataFrame:
    """The rows of :func:`read_exports`."""
    return read_exports(spark, paths, columns, splittable)[0]


def list_exports(spark: SparkSession, directory: str) -> list[str]:
    """Globs of the families of list exports that a directory holds, and its table of answers."""

    def held(glob: str) -> bool:
        try:
            spark.read.text(glob)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    names = (fv.CLEANED_PREFIX, fv.REGULATION_PREFIX, f"{SRC_FILE}={fv.REGULATION_PREFIX}")
    globs = [f"{directory}/{name}*.csv" for name in names]
    return [g for g in [*globs, f"{directory}/{ANSWERS}"] if held(g)]


def write_list_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).options(**CSV_WRITE).csv(path)
