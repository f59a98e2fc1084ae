"""Secret scans over every version of every file, each content scanned once per rule.

A version's content is its blob, addressed by SHA-256. The ledger, a Parquet table, holds
for each blob the rule versions it was scanned with and the matches found. A scan keeps
the blobs that the ledger lacks for some rule version, scans them for those rules only,
appends what it did, and joins the findings of the asked rule versions back to every path
that holds the blob. Runs without a rule version, as older ledgers have, do not count as
scanned.
Copies of a blob are dropped before the shuffle, so a content that makes up a third of
all rows is moved once per task and scanned once.

Spark's own expressions do the matching. A rule's matches and the gaps between them
(``regexp_extract_all`` and ``split`` by the same pattern) alternate, so the places are
running sums of lengths, in code points. Matches that are too short count in these sums
and are dropped afterwards, which keeps matching leftmost and non-overlapping.

Defined cases: null content is empty content; repeated rows each get the findings;
an empty table adds nothing; null paths are kept. Extra columns are not read. Running a
scan again after a failed one adds no finding twice, as the ledger is read by blob and
rule version.
"""

import uuid
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.columns import let
from rollcall.operators.small_tables import shared_folder


@dataclass(frozen=True)
class Rule:
    """A pattern whose group ``value`` (0: all of it) must have ``least`` code points."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1
    base: bool = False

    @property
    def version(self) -> str:
        return f"{self.kind}-{sha256(f'{self.pattern} {self.value} {self.least}'.encode()).hexdigest()[:12]}"


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", ASSIGN, 2, 8, base=True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, base=True),
    Rule("hex", "[0-9a-f]{32,}", 0, 32, base=True),  # a maximal run, as of [0-9a-f]+
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}"),
)
#: Every match of a rule begins with or holds one of these.
SIGNS = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}|gh[opsur]_|AIza|eyJ|-----BEGIN |xox[abeoprs]-"
RUNS = "array<struct<kind:string,version:string,gaps:array<int>,sizes:array<int>,values:array<int>>>"
LEDGER = f"blob string, rules array<string>, runs {RUNS}"


def _runs(content: Column, rule: Rule) -> Column:
    """Lengths of the gaps, matches and values of one rule, alternating from the start."""
    pattern = F.lit(rule.pattern)
    lengths = lambda found: F.transform(found, lambda x: F.length(x))
    sizes = let(F.regexp_extract_all(content, pattern, F.lit(0)), lengths)
    values = let(F.regexp_extract_all(content, pattern, F.lit(rule.value)), lengths) if rule.value else F.array().cast("array<int>")
    return F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), lengths(F.split(content, rule.pattern)).alias("gaps"), sizes.alias("sizes"), values.alias("values"))


def _with_blobs(versions: DataFrame, path_col: str, content_col: str) -> DataFrame:
    content = F.coalesce(F.col(content_col), F.lit(""))
    return versions.select(F.col(path_col).alias("path"), F.sha2(content, 256).alias("blob"), content.alias("content"))


def new_ledger(spark: SparkSession) -> str:
    """A place for a ledger in the shared folder."""
    return f"{shared_folder(spark)}/rollcall/ledger-{uuid.uuid4().hex}"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's table; empty if nothing was scanned yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_unseen(versions: DataFrame, ledger: str, path_col: str = "path", content_col: str = "content",
                rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks, and append it."""
    spark = versions.sparkSession
    wanted = F.array(*[F.lit(r.version) for r in rules])
    known = read_ledger(spark, ledger).filter(~F.exists("runs", lambda r: r["version"].isNull()))
    seen = known.select("blob", F.explode("rules").alias("rule"))
    # A blob has a row per rule version at most, however often it was scanned.
    seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    blobs = _with_blobs(versions, path_col, content_col).select("blob", "content").dropDuplicates(["blob"])
    todo = F.array_except(wanted, F.coalesce("seen", F.expr("cast(array() as array<string>)")))
    fresh = blobs.join(seen, "blob", "left").select("blob", "content", todo.alias("todo")).filter(F.size("todo") > 0)
    content = F.col("content")
    runs = F.filter(
        F.array(*[F.when(F.array_contains("todo", r.version), _runs(content, r)) for r in rules]),
        lambda r: r.isNotNull() & (F.size(r["sizes"]) > 0),
    )
    none = F.expr(f"cast(array() as {RUNS})")
    signs = F.lit(True) if any(r not in RULES for r in rules) else content.rlike(SIGNS)
    scanned = fresh.select("blob", F.col("todo").alias("rules"), F.when(signs, runs).otherwise(none).alias("runs"))
    scanned.write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``spans`` (start, number of the rule, kind, end) of blobs with any, in order."""
    known = read_ledger(spark, ledger).select("blob", F.explode("runs").alias("r")).select("blob", "r.*")
    known = known.filter(F.col("version").isin([r.version for r in rules])).dropDuplicates(["blob", "version"])
    parts = known.select("blob", "kind", "version", F.posexplode(F.arrays_zip("gaps", "sizes", "values")).alias("at", "part")).select(
        "blob", "kind", "version", "at", "part.*").filter("sizes IS NOT NULL")
    before = W.partitionBy("blob", "version").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)  # one text's matches
    end = F.sum(F.col("gaps") + F.col("sizes")).over(before)
    placed = parts.select("blob", "kind", "version", (end - F.col("sizes")).alias("start"), end.alias("end"), F.coalesce("values", "sizes").alias("value"))
    number = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.version, i)])[F.col("version")]
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.version, r.least)])[F.col("version")]
    held = placed.filter(F.col("value") >= least).select("blob", F.struct("start", number.alias("no"), "kind", "end").alias("span"))
    return held.groupBy("blob").agg(F.sort_array(F.collect_list("span")).alias("spans"))  # one text's findings


def scan_secrets(versions: DataFrame, ledger: str | None = None, path_col: str = "path", content_col: str = "content",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path``, ``blob`` and ``spans`` of every version, those without findings included."""
    spark = versions.sparkSession
    ledger = ledger or new_ledger(spark)
    scan_unseen(versions, ledger, path_col, content_col, rules)
    paths = _with_blobs(versions, path_col, content_col).select("path", "blob")
    empty = F.expr("cast(array() as array<struct<start:bigint,no:int,kind:string,end:bigint>>)")
    return paths.join(findings(spark, ledger, rules), "blob", "left").select("path", "blob", F.coalesce("spans", empty).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", ledger: str | None = None,
           rules: tuple[Rule, ...] = RULES, size_col: str | None = None) -> DataFrame:
    """``docs`` with every finding in the text replaced by ``mark``; overlapping ones by a single mark.

    ``size_col``, if given, is set to the length of the new text where the text changes.
    """
    spark = docs.sparkSession
    ledger = ledger or new_ledger(spark)
    scan_unseen(docs.select(F.lit(None).cast("string").alias("path"), F.col(text_col).alias("content")), ledger, rules=rules)
    found = findings(spark, ledger, rules).select(F.col("blob").alias("_rollcall_found"), "spans")
    marked = docs.withColumn("_rollcall_blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    joined = marked.join(found.withColumnRenamed("spans", "_rollcall_spans"), F.col("_rollcall_blob") == F.col("_rollcall_found"), "left")
    text = F.col(text_col)
    # Pieces of the text that stand before, between and after the merged spans.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
        s["end"].alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out")))
    clean = F.aggregate("_rollcall_spans", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    hit = F.col("_rollcall_spans").isNotNull()
    ready = joined.withColumn("_rollcall_clean", F.when(hit, clean))
    new = {text_col: F.when(hit, F.col("_rollcall_clean")).otherwise(text)}
    if size_col:
        kind = docs.schema[size_col].dataType
        new[size_col] = F.when(hit, F.length("_rollcall_clean").cast(kind)).otherwise(F.col(size_col))
    return ready.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
