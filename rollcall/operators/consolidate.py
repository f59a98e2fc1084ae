"""Many sources to one table: label, unite, normalise, keep first, sort.

Row order decides who wins, and Spark rows have none, so every source carries
``src_rank`` (place of its family), ``src_file`` and ``row_pos`` from the scan.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import fixed_values as fv
from rollcall.functions import dates, labels
from rollcall.operators.small_tables import join_small

SRC_RANK, SRC_FILE, ROW_POS = "src_rank", "src_file", "row_pos"
ORDER = (SRC_RANK, SRC_FILE, ROW_POS)


def tag_source(df: DataFrame, rank: int, file: str | Column, pos: str | Column) -> DataFrame:
    name = F.lit(file) if isinstance(file, str) else file
    place = F.col(pos) if isinstance(pos, str) else pos
    return df.withColumns({SRC_RANK: F.lit(rank), SRC_FILE: name, ROW_POS: place})


def unite(*sources: DataFrame) -> DataFrame:
    """All rows under the columns of all sources, gaps null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def align_columns(listed: DataFrame) -> DataFrame:
    """Full-list columns under the feed's names, where both mean the same."""
    return listed.withColumnsRenamed(fv.LIST_TO_FEED_COLUMNS)


def first_places(rows: DataFrame) -> DataFrame:
    """(src_file, first_place): each file's smallest place, null if it has none.

    Places end in a number. It is aggregated by the columns ahead of it, in hash
    tables, and the few results are compared as a whole.
    """
    kind = rows.schema[ROW_POS].dataType
    parts = [F.col(f"{ROW_POS}.{f.name}") for f in kind.fields] if isinstance(kind, T.StructType) else [F.col(ROW_POS)]
    ahead = [p.alias(f"ahead{i}") for i, p in enumerate(parts[:-1])]
    least = rows.groupBy(SRC_FILE, *ahead).agg(F.min(parts[-1]).alias("least"))
    if not ahead:
        return least.withColumnRenamed("least", "first_place")
    names = [f"ahead{i}" for i in range(len(ahead))]
    first = F.row_number().over(Window.partitionBy(SRC_FILE).orderBy(*[F.asc_nulls_last(n) for n in (*names, "least")])) == 1
    place = F.struct(*[F.col(n).alias(f.name) for n, f in zip([*names, "least"], kind.fields)])
    return least.withColumn("first", first).filter("first").select(SRC_FILE, place.alias("first_place"))


def first_rows(rows: DataFrame) -> DataFrame:
    """(src_file, Source, Watchlist) of each file's first row, nulls included.

    Only places are aggregated; the rows themselves are picked by a join with them.
    Of rows that share a file's first place, that with the least texts counts.
    """
    seen = [c if c in rows.columns else None for c in ("Source", "Watchlist")]
    source, watchlist = (F.col(c) if c else F.lit(None).cast("string") for c in seen)
    named = rows.select(SRC_FILE, ROW_POS, source.alias("Source"), watchlist.alias("Watchlist"))
    kind = rows.schema[ROW_POS].dataType
    own = F.struct(*[F.col(f"{ROW_POS}.{f.name}") for f in kind.fields]) if isinstance(kind, T.StructType) else F.col(ROW_POS)
    firsts = join_small(named, first_places(rows), SRC_FILE, ROW_POS).filter(own.eqNullSafe(F.col("first_place")))
    place = F.row_number().over(Window.partitionBy(SRC_FILE).orderBy("Source", "Watchlist"))
    return firsts.withColumn("place", place).filter("place = 1").select(SRC_FILE, "Source", "Watchlist")


def recognise_files(rows: DataFrame) -> DataFrame:
    """Which export each file is, told by its first row: feed, list, or neither."""
    kind = (
        F.when(labels.is_list_source(F.col("Source")), F.lit("list"))
        .when(labels.is_feed_watchlist(F.col("Watchlist")), F.lit("feed"))
        .otherwise(F.lit("unknown"))
    )
    return first_rows(rows).select(SRC_FILE, kind.alias("kind"))


def file_labels(rows: DataFrame) -> DataFrame:
    """(src_file, file_watchlist): one label per file."""
    label = labels.file_label(F.col(SRC_FILE), F.col("Source"), F.col("Watchlist"))
    return first_rows(rows).select(SRC_FILE, label.alias("file_watchlist"))


def with_labels(rows: DataFrame, per_file: DataFrame) -> DataFrame:
    """Overwrite Watchlist with the label of the row's file."""
    return join_small(rows.drop("Watchlist"), per_file, SRC_FILE, ROW_POS).withColumnRenamed(
        "file_watchlist", "Watchlist"
    )


def label_files(rows: DataFrame) -> DataFrame:
    return with_labels(rows, file_labels(rows))


def normalise(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Standard birth dates and list labels, for whichever column is there."""
    changed = {}
    if "DOB_DJ" in rows.columns:
        changed["DOB_DJ"] = dates.standardise_date(F.col("DOB_DJ"))
    if "Watchlist" in rows.columns:
        changed["Watchlist"] = labels.standard_watchlist(F.col("Watchlist"), strict)
    return rows.withColumns(changed) if changed else rows


def converted_dates(rows: DataFrame, column: str = "DOB_DJ") -> DataFrame:
    return rows.agg(F.count_if(dates.is_standard_date(F.col(column))).alias("converted"))


def keep_first(rows: DataFrame, key: str = "Name", order=ORDER) -> DataFrame:
    """The first row of every key; all rows without a key are one group.

    Spark plans the rank filter as a group limit on both sides of the shuffle,
    so each task sends one row per key at most, however hot the key. The hash
    ahead of the key halves the sorting: names share long beginnings, and a
    number settles most comparisons without reading them.
    """
    place = F.row_number().over(Window.partitionBy("key_hash", key).orderBy(*order))
    hashed = rows.withColumn("key_hash", F.xxhash64(key))
    return hashed.withColumn("place", place).filter(F.col("place") == 1).drop("place", "key_hash")


def sort_by_name(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("Name").asc_nulls_last())


def consolidate(
    rows: DataFrame, normalised: bool = True, strict: bool = False, per_file: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """United rows to the final table.

    ``normalised`` is the batch job: labels per file, standard dates and
    labels, sorted by name. Without it rows are only deduplicated, as the
    interactive job does; the caller's ``src_rank`` decides who comes first.

    Who is kept depends on names and places alone, so labels and dates are
    worked out after the dedupe, for the rows that remain. The labels
    themselves come from all rows, whose first ones may be dropped; a caller who
    has worked out :func:`file_labels` passes them as ``per_file``. The sort
    runs ahead of normalising, as it evaluates its input twice, once to sample; who only
    counts the rows goes without (``ordered=False``).
    """
    kept = keep_first(rows)
    if not normalised:
        return kept
    labelled = with_labels(kept, file_labels(rows) if per_file is None else per_file)
    return normalise(sort_by_name(labelled) if ordered else labelled, strict)
