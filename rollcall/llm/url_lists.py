"""URL filters: captures against lists as they were when the capture was fetched.

A list is a table of dated entries: a key (a domain, or a domain with the first parts of
a path) is blocked, allowed or removed from a day on. An entry holds until the list's
next entry for the same key, so the entries become validity intervals. A capture is
looked up under its host, the domains above it and its path, up to as many parts as the
longest entry has, and meets at most one interval per list and key: that which covers
its fetch day. Of all active entries the longest key decides, and of equal ones the
permission.

Verdicts depend on address and day alone, so equal captures are looked up once. The as-of
join keeps the intervals of a list and key as one row, an array in order of their days, and
finds the last that began by the fetch day by halving: a capture makes one row per list and
key it meets, however many entries that key has had. Spark broadcasts the lists if they are
small, and splits hosts with many captures otherwise. Entries of one key, list and day are
merged first, so an array has at most one interval per day.

Keys and addresses are read by the same rules: scheme, user and port are left out, the host
is taken in lower case, empty path parts are dropped, paths keep their case, and a query or
fragment is no part of a key.

Defined cases: captures without an address or day are not blocked; of entries of one
list, key and day, "allow" comes before "block" and "block" before "remove"; entries
without a key, host, day or known action are ignored; repeated captures each get the
verdict. Extra columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators.small_tables import materialise

ACTIONS = ("allow", "block", "remove")  # in order of precedence


_SCHEME, _HOST = r"[A-Za-z][A-Za-z0-9+.-]*://", r"(?:[^/?#@]*@)?([^/?#:]*)"
DAYS = 22  # halvings: more intervals than there are days


def host_of(url: Column) -> Column:
    """Lower-case host; null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, f"^{_SCHEME}{_HOST}", 1)), F.lit(""))


def path_parts_of(url: Column) -> Column:
    """The parts of the path, empty ones left out, whether the address has a scheme or not."""
    path = F.regexp_extract(url, f"^(?:{_SCHEME})?[^/?#]*/([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda p: p != "")


def keys_of(url: Column, path_parts: int) -> Column:
    """Keys a list may have for the address: its domains, and its host with up to ``path_parts`` path parts."""
    host, parts = host_of(url), path_parts_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(
        F.filter(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(path_parts))), lambda i: i > 0),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, paths)))


def list_key(key: Column) -> Column:
    """A list's key as :func:`keys_of` makes them; null without a host."""
    host = F.nullif(F.lower(F.regexp_extract(key, f"^(?:{_SCHEME})?{_HOST}", 1)), F.lit(""))
    return F.concat(host, F.array_join(F.transform(path_parts_of(key), lambda p: F.concat(F.lit("/"), p)), ""))


def intervals(entries: DataFrame) -> DataFrame:
    """``list``, ``key``, ``action``, ``since`` and ``until`` (the first day it no longer holds)."""
    rank = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    known = entries.withColumn("key", list_key(F.col("key")))
    known = known.filter(F.col("key").isNotNull() & F.col("since").isNotNull() & F.col("action").isin(*ACTIONS))
    daily = known.groupBy("list", "key", F.col("since").cast("date").alias("since")).agg(F.min(rank).alias("rank"))
    following = F.lead("since").over(W.partitionBy("list", "key").orderBy("since"))
    action = F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), F.col("rank").cast("int"))
    return daily.select("list", "key", action.alias("action"), "since", following.alias("until")).filter("action != 'remove'")


def histories(entries: DataFrame) -> DataFrame:
    """``list``, ``key`` and ``history``: its intervals in order, one at most per day."""
    return intervals(entries).groupBy("list", "key").agg(F.sort_array(F.collect_list(F.struct("since", "until", "action"))).alias("history"))


def as_of(history: Column, day: Column) -> Column:
    """The interval that covers the day, or null: the last one begun by then is found by halving."""
    begun = lambda n: F.get(history, n - 1)["since"] <= day
    count = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(DAYS))]), F.lit(0), lambda n, s: F.when(begun(n + s), n + s).otherwise(n))
    last = F.get(history, count - 1)
    return F.when(last["until"].isNull() | (day < last["until"]), last)


def apply_lists(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "fetched") -> DataFrame:
    """One row per capture: ``page_id``, ``url``, ``fetched``, ``n_active``, ``decided_by`` and ``blocked``."""
    lists = materialise(histories(entries))
    longest = lists.agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(day_col).cast("date").alias("fetched"))
    asked = rows.select("url", "fetched").filter("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    looked = asked.select("url", "fetched", F.explode(keys_of(F.col("url"), longest)).alias("key"))
    found = looked.join(lists, "key").select("url", "fetched", "key", as_of(F.col("history"), F.col("fetched")).alias("entry"))
    active = found.filter("entry IS NOT NULL").select("url", "fetched", "key", "entry.action")
    order = F.struct(F.length("key").alias("size"), (F.col("action") == "allow").alias("allow"), F.col("key"))
    decided = active.groupBy("url", "fetched").agg(F.max(order).alias("best"), F.count("*").alias("n_active"))
    verdict = decided.select(F.col("url").alias("_url"), F.col("fetched").alias("_day"), "n_active", F.col("best.key").alias("decided_by"), (~F.col("best.allow")).alias("blocked"))
    return rows.join(verdict, (F.col("url") == F.col("_url")) & (F.col("fetched") == F.col("_day")), "left").select(
        "page_id", "url", "fetched", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), "decided_by", F.coalesce("blocked", F.lit(False)).alias("blocked"))
