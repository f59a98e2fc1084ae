"""Near duplicates by SimHash, found through anchor points of a covering code.

A document's fingerprint has 64 bits. Two documents are linked when their fingerprints
differ in at most ``THRESHOLD`` bits, and links are followed to whole components.

Anchors are the words of a covering code over the first 46 bits: two blocks of the
binary Golay code of 23 bits, which is perfect, so each block lies within radius 3 of
exactly one code word. A fingerprint's *home* is the anchor made of these two. Of two
linked fingerprints, one lies at most 3 bits per block from its home, and the other at
most the threshold further, taken over both blocks. Each fingerprint is therefore sent
to its home, and as a replica to every anchor that its blocks reach with at most
``THRESHOLD`` bits beyond the radius: 62 rows on average, whatever the data. Fingerprints
are compared only at equal anchors, home against replica, and each pair is met once.

Only distinct fingerprints are compared, so exact copies cost nothing, and a fingerprint
has at most 2,080 others within two bits, however many copies there are. Anchors that
are home to more than ``HOT_HOMES`` distinct fingerprints would make one task compare
too many: there, each fingerprint's 2,080 neighbours are looked up by equality instead,
which is linear and exact as well.

Spark sizes the replicas as if a fingerprint had one, and would broadcast them all. They and
the tables of fingerprints and documents are shuffled, whatever Spark takes their sizes to
be. Only the rows to keep may be broadcast, as Spark has counted their bytes by then.

Defined cases: null and blank texts have fingerprint zero and are linked like any other;
rows with equal or null ids are rows of their own; a component whose ids are all null has
a null component id; an empty table gives an empty result. Other columns are not read.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import connected
from rollcall.llm.words import spaced_words
from rollcall.operators.small_tables import materialise, shuffled

SHINGLE = 3
SEED = 42
THRESHOLD = 2
HOT_HOMES = 16_384
_SLICE = 65_536

GOLAY_BITS, GOLAY_RADIUS = 23, 3
GOLAY_POLYNOMIAL = 0b101011100011  # generator of the binary Golay code
BLOCKS = 2


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half the shingle hashes; 0 without words."""
    words = spaced_words(text)
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SLICE):
        some = words[at : min(at + _SLICE, n) + size - 1]
        shingles = map(b" ".join, zip(*(some[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``row`` (a hash of the text, to tell rows of one id apart), ``fp``."""

    def prints(batches):
        for b in batches:
            fps = [fingerprint(t) for t in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps, pa.int64())], names=["id", "row", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(prints, "id long, row long, fp long")


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    for bit in range(GOLAY_BITS - 1, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GOLAY_POLYNOMIAL << bit - 11), words)
    return words


class Anchors:
    """Ways from a 23-bit block to the code words around it, by syndrome."""

    def __init__(self, threshold: int = THRESHOLD) -> None:
        self.threshold = threshold
        # The remainder is linear: that of a block is the sum of those of its halves.
        self.low, self.high = _remainders(np.arange(1 << 12)).tolist(), _remainders(np.arange(1 << 11) << 12).tolist()
        steps: list[list[list[int]]] = [[[] for _ in range(threshold + 1)] for _ in range(1 << 11)]
        for weight in range(GOLAY_RADIUS + threshold + 1):
            for bits in combinations(range(GOLAY_BITS), weight):
                step = sum(1 << b for b in bits)
                steps[self.syndrome(step)][max(0, weight - GOLAY_RADIUS)].append(step)
        self.steps = [[np.array(x, dtype=np.int64) for x in by_excess] for by_excess in steps]

    def syndrome(self, block: int) -> int:
        return self.low[block & 0xFFF] ^ self.high[block >> 12]

    def around(self, fp: int) -> tuple[int, np.ndarray]:
        """Home anchor, and all anchors a replica goes to."""
        mask = (1 << GOLAY_BITS) - 1
        a, b = fp & mask, fp >> GOLAY_BITS & mask
        ways_a, ways_b = self.steps[self.syndrome(a)], self.steps[self.syndrome(b)]
        found = [
            ((b ^ y) << GOLAY_BITS)[:, None] | (a ^ x)[None, :]
            for i, x in enumerate(ways_a)
            for y in ways_b[: self.threshold - i + 1]
        ]
        every = np.concatenate([f.ravel() for f in found])
        return int(every[0]), every


def _replicas(fps: DataFrame, threshold: int) -> DataFrame:
    """``anchor``, ``fp``, ``home`` for each anchor of each distinct fingerprint."""

    def spread(batches):
        anchors = Anchors(threshold)
        for batch in batches:
            values = batch.column(0).to_pylist()
            for at in range(0, len(values), 1000):
                some = values[at : at + 1000]
                reach = [anchors.around(v)[1] for v in some]
                sizes = [len(r) for r in reach]
                home = np.zeros(sum(sizes), dtype=bool)
                home[np.cumsum([0, *sizes[:-1]])] = True
                yield pa.record_batch(
                    [pa.array(np.concatenate(reach)), pa.array(np.repeat(np.array(some, dtype=np.int64), sizes)), pa.array(home)],
                    names=["anchor", "fp", "home"],
                )

    return fps.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean")


def _homes(fps: DataFrame, threshold: int) -> DataFrame:
    def decode(batches):
        anchors = Anchors(threshold)
        for batch in batches:
            home = [anchors.around(v)[0] for v in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(home, pa.int64()), batch.column(0)], names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(decode, "anchor long, fp long")


def _looked_up(hot: DataFrame, fps: DataFrame, threshold: int) -> DataFrame:
    """Links of the given fingerprints, by equality with each possible neighbour."""

    def neighbours(batches):
        flips = np.array(
            [sum(1 << b for b in bits) for w in range(1, threshold + 1) for bits in combinations(range(64), w)],
            dtype=np.uint64,
        )
        for batch in batches:
            values = np.array(batch.column(0).to_pylist(), dtype=np.int64).view(np.uint64)
            for at in range(0, len(values), 100):
                near = values[at : at + 100, None] ^ flips[None, :]
                yield pa.record_batch(
                    [pa.array(np.repeat(values[at : at + 100], len(flips)).view(np.int64)), pa.array(near.ravel().view(np.int64))],
                    names=["a", "b"],
                )

    near = hot.select("fp").mapInArrow(neighbours, "a long, b long")
    return near.join(shuffled(fps.select(F.col("fp").alias("b"))), "b", "left_semi").select("a", "b")


def links(fps: DataFrame, threshold: int = THRESHOLD, hot_homes: int = HOT_HOMES) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints that differ in few bits.

    ``fps`` has a column ``fp`` without repeats, and is read more than once.
    """
    homes = materialise(_homes(fps, threshold))
    crowded = homes.groupBy("anchor").count().filter(F.col("count") > hot_homes).select("anchor")
    replicas = _replicas(fps, threshold).select("anchor", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    calm = homes.join(crowded, "anchor", "left_anti").select("anchor", F.col("fp").alias("a"))
    compared = calm.join(shuffled(replicas), "anchor").filter(near & (F.col("a") < F.col("b"))).select("a", "b")
    hot = homes.join(crowded, "anchor", "left_semi")
    return compared.union(_looked_up(hot, fps, threshold))


def groups(prints: DataFrame, threshold: int = THRESHOLD, hot_homes: int = HOT_HOMES) -> DataFrame:
    """``fp`` and ``component_id`` of every distinct fingerprint."""
    fps = materialise(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = connected(links(fps, threshold, hot_homes))
    rooted = fps.join(shuffled(roots.withColumnRenamed("node", "fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(shuffled(smallest), "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD, hot_homes: int = HOT_HOMES) -> DataFrame:
    """One row per document: ``doc_id``, ``row``, ``fingerprint`` in hex, ``component_id``."""
    prints = materialise(fingerprints(docs, id_col, text_col))
    return prints.join(shuffled(groups(prints, threshold, hot_homes)), "fp").select(
        F.col("id").alias("doc_id"), "row",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component: that with the smallest id.

    Of rows that share this id, the one whose text has the smallest hash stays, once.
    """
    prints = materialise(fingerprints(docs, id_col, text_col))
    found = prints.join(shuffled(groups(prints)), "fp")
    keep = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("k"))
    # All-null components share the null id; they are told apart by their fingerprints.
    nameless = found.filter(F.col("component_id").isNull()).groupBy("fp").agg(F.min("row").alias("row"))
    kept = keep.filter(F.col("component_id").isNotNull()).select(F.col("k.id").alias("_rollcall_id"), F.col("k.row").alias("_rollcall_row"))
    kept = kept.union(nameless.select(F.lit(None).cast("long"), "row")).distinct()
    marked = docs.withColumn("_rollcall_doc", F.col(id_col).cast("long")).withColumn("_rollcall_hash", F.xxhash64(text_col))
    held = marked.join(kept, F.col("_rollcall_doc").eqNullSafe(F.col("_rollcall_id")) & (F.col("_rollcall_hash") == F.col("_rollcall_row")), "left_semi")
    return held.dropDuplicates(["_rollcall_doc", "_rollcall_hash"]).select(*[F.col(f"`{c}`") for c in docs.columns])
