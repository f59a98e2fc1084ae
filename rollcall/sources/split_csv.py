"""Records of CSV files too large for one task: quoted line breaks, read by many.

The text source cuts a file into blocks of lines, and a line alone does not tell whether it
begins inside a quoted field. But it tells what it does to either state: with no quote it
keeps it, and with quotes it usually ends outside whatever it began in. These little maps
are composed along a run of lines by two running figures, the number of lines that swap the
states so far and the last line that fixes one, and then along the runs of a file, one row
each. So every run learns the state it begins in, and with it which of its lines begin a
record and which still belong to one begun in a run before.

A run is at most ``RUN_LINES`` lines of a block, so no window holds more than these, however
short the lines of a block are. Lines are shuffled once, by run, and sorted in shares of
about ``SHARE_BYTES`` of the files, so a task's memory does not grow with them. Records of
one line go no further; the lines of others are brought together by record, in as many
shares. A record must fit one value, as for any reader. A quote counts only at the start of
a field, and a field closed by a quote runs on to the next comma.

Line ends are ``\\n`` or ``\\r\\n``; empty lines are no records, as for Spark's own reader.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators.small_tables import join_known, materialise

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+)'
# A line that begins outside, or inside, a quoted field and ends inside one.
OPENS = rf'(?s)\A(?:{_FIELD},)*+"{_INSIDE}\z'
STAYS = rf'(?s)\A{_INSIDE}(?:\z|"[^,]*+,(?:{_FIELD},)*+"{_INSIDE}\z)'
PART, BLOCK, RUN = "part", "block", "run"
RUN_BITS = 12
RUN_LINES = 1 << RUN_BITS
SHARE_BYTES = 8 * 1024 * 1024


def _after(start: Column | int, base: str, swaps: str) -> Column:
    """The state (1 inside) behind some lines: by the last one that fixed it, else by the start, and the swaps."""
    begun = F.lit(start) if isinstance(start, int) else start
    return F.pmod(F.coalesce(F.col(base), begun) + F.col(swaps), F.lit(2))


def _composed(df: DataFrame, group: tuple[str, ...], *order: str) -> DataFrame:
    """``base_upto`` and ``swaps_upto``, the map of all rows up to each in its group, and ``base`` and ``swaps`` of those before.

    ``base_here`` and ``swaps_here`` are the row's own: the state it fixes, if any, less its swaps, and these.
    """
    along = W.partitionBy(*group).orderBy(*order)
    upto, before = along.rowsBetween(W.unboundedPreceding, 0), along.rowsBetween(W.unboundedPreceding, -1)
    summed = df.withColumn("swaps_upto", F.sum("swaps_here").over(upto))
    # What fixes the state leaves it less the swaps so far; these are added again where it is used.
    fixed = F.when(F.col("base_here").isNotNull(), F.pmod(F.col("base_here") + F.col("swaps_here") - F.col("swaps_upto"), F.lit(2)))
    return summed.withColumn("fixed", fixed).withColumns({
        "base": F.last("fixed", ignorenulls=True).over(before), "base_upto": F.last("fixed", ignorenulls=True).over(upto),
        "swaps": F.col("swaps_upto") - F.col("swaps_here")}).drop("fixed", "base_here", "swaps_here")


def _shares(spark: SparkSession, paths) -> int:
    """Into how many shares the lines of the files are dealt."""
    size = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0
    return max(spark.read.text(paths).rdd.getNumPartitions(), -(-size // SHARE_BYTES), 1)


def _lines(spark: SparkSession, paths, shares: int | None = None) -> DataFrame:
    """Every line with its file, block, run and place in it, and the records (by their places) it would begin or belong to for either start of its run."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias(PART), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias("at"), "value",
        F.col("value").rlike(OPENS).cast("int").alias("opens"), F.col("value").rlike(STAYS).cast("int").alias("stays"))
    runs = lines.withColumn(RUN, F.shiftright("at", RUN_BITS)).repartition(shares or _shares(spark, paths), PART, BLOCK, RUN)
    own = runs.withColumns({
        "base_here": F.when(F.col("opens") == F.col("stays"), F.col("opens")),
        "swaps_here": ((F.col("opens") == 1) & (F.col("stays") == 0)).cast("int")}).drop("opens", "stays")
    order = W.partitionBy(PART, BLOCK, RUN).orderBy("at")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    out = _composed(own.withColumn("line", F.row_number().over(order).cast("long") - 1), (PART, BLOCK, RUN), "at")
    out = out.withColumn("ends_run", F.lead("at").over(order).isNull())
    for s in (0, 1):
        begins = _after(s, "base", "swaps") == 0
        out = out.withColumn(f"begins{s}", begins)
        out = out.withColumn(f"record{s}", F.last(F.when(F.col(f"begins{s}"), F.col("line")), ignorenulls=True).over(upto))
        out = out.withColumn(f"alone{s}", F.col(f"begins{s}") & F.coalesce(F.lead(f"begins{s}").over(order), F.lit(False)))
    return out.select(PART, BLOCK, RUN, "line", "value", "ends_run", "base_upto", "swaps_upto", "record0", "record1", "alone0", "alone1")


def block_starts(lines: DataFrame) -> DataFrame:
    """Of every run ``inside`` (1 if it begins in a quoted field), ``first``, the lines of its file before it, and ``open_record``, begun before it."""
    # The last line of a run knows all of it: a row per run.
    runs = lines.filter("ends_run").select(
        PART, BLOCK, RUN, (F.col("line") + 1).alias("n_lines"), F.col("base_upto").alias("base_here"), F.col("swaps_upto").alias("swaps_here"), "record0", "record1")
    before = W.partitionBy(PART).orderBy(BLOCK, RUN).rowsBetween(W.unboundedPreceding, -1)
    runs = _composed(runs, (PART,), BLOCK, RUN).withColumn("inside", _after(0, "base", "swaps"))
    runs = runs.withColumn("first", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
    last = F.col("first") + F.when(F.col("inside") == 0, F.col("record0")).otherwise(F.col("record1"))
    return runs.withColumn("last", last).select(PART, BLOCK, RUN, "inside", "first", F.last("last", ignorenulls=True).over(before).alias("open_record"))


def split_records(spark: SparkSession, paths) -> DataFrame:
    """``part``, ``row`` and ``record``, the text of every record; ``row`` is the place of its first line in the file."""
    shares = _shares(spark, paths)
    lines = materialise(_lines(spark, paths, shares))
    run = F.struct(PART, BLOCK, RUN)
    starts = materialise(block_starts(lines).select(run.alias("place"), "inside", "first", "open_record"))
    known = join_known(lines.withColumn("place", run), starts, "place", "line")
    outside = F.col("inside") == 0
    placed = known.select(
        PART, (F.col("first") + F.col("line")).alias("row"), "value", F.when(outside, F.col("alone0")).otherwise(F.col("alone1")).alias("alone"),
        F.coalesce(F.col("first") + F.when(outside, F.col("record0")).otherwise(F.col("record1")), "open_record").alias("record_row"))
    alone = placed.filter("alone").select(PART, "row", F.col("value").alias("record"))
    of_record = W.partitionBy(PART, "record_row").orderBy("row").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    dealt = placed.filter("NOT alone").repartition(shares, PART, "record_row").withColumn("lines", F.collect_list("value").over(of_record))
    joined = dealt.filter("row = record_row").select(PART, "row", F.array_join("lines", "\n").alias("record"))
    whole = alone.union(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return whole.filter("record != ''")
