"""Fingerprints whose likeness follows edit distance: randomised edit embedding.

Every text is walked by the same random rule: at step ``j`` the pointer reads a character
and moves on by one or not at all, as a random bit of (walk, step, character) says. An edit
lets two walks part, and chance brings their pointers together again soon, so texts of small
edit distance are embedded at small Hamming distance. A walk has two steps a character.

A fingerprint is a sample of the embedded text: of each walk ``SLOTS`` steps, each giving a
hex digit of what the pointer reads there. A slot's step is drawn evenly over the walk, as
a reservoir of size one draws it: a longer walk replaces the step with the chance that
evenness needs, so walks of unlike lengths still share most of their steps. Two unrelated
texts agree in a sixteenth of the digits; likeness is the share of equal digits beyond that.

Bands of ``BAND`` bit-sampled digits bring similar fingerprints together (``BANDS`` of them:
texts that agree in 0.8 of their digits meet in one band at least with a chance of 0.997).
Members of a bucket are verified against each other by their whole fingerprints, in tiles of
bounded size however many there are, and a pair is counted in its first common band only.
A tile returns the number of each member's links and a spanning forest, never its pairs.

Documents are dealt by stretches of their id, so that the next document is the next row of
its task; the first document of each stretch is sent along to the stretch before it. Walks
of a slice of texts are stepped together by arrays; the few longest texts end alone.

Defined cases: a null text is empty, and an empty text's digits are zeros; equal texts have
equal fingerprints; equal ids are ordered by a hash of their texts; null ids come first;
of a single document the next one is itself; an empty table gives an empty result. Long
texts are walked whole, in time and memory in proportion to their length. Other columns
are not read.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import connected
from rollcall.operators.small_tables import materialise

SEED = 20_240_101
WALKS, SLOTS, GRAM = 2, 64, 4
BANDS, BAND = 32, 8
LEAST = 0.8
TOGETHER = 16
STEPS = 65_536
SLICE_CHARS = 2_000_000
TILE = 512
MASK = (1 << 64) - 1
NO_ID = -(1 << 63)
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random (the finalizer of splitmix64)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random(stream: int, numbers: np.ndarray) -> np.ndarray:
    return _mix(_mix(np.uint64(SEED + stream) + np.zeros(1, np.uint64)) ^ numbers.astype(np.uint64))


def _multipliers(first: int, n: int) -> np.ndarray:
    """The odd numbers that make a step's bits of the characters, for ``n`` steps of every walk."""
    steps = np.arange(first, first + n)
    return np.stack([_random(w, steps) | np.uint64(1) for w in range(WALKS)], axis=1)


def _records() -> list[np.ndarray]:
    """Each slot's steps in the order in which longer walks take them on."""
    out = []
    for slot in range(WALKS * SLOTS):
        chances = (_random(1000 + slot, np.arange(400)) >> np.uint64(11)).astype(np.float64) / 2**53
        at, steps = 0, [0]
        for u in chances:
            at = max(at + 1, int((at + 1) / max(u, 1e-12)))
            steps.append(at)
            if at > 1 << 40:
                break
        out.append(np.array(steps, dtype=np.int64))
    return out


class Embedder:
    """Digits of texts; one per task, as it keeps its random numbers."""

    def __init__(self) -> None:
        self.records = _records()
        self.blocks: dict[int, np.ndarray] = {}

    def _block(self, no: int) -> np.ndarray:
        if no not in self.blocks:
            if len(self.blocks) > 16:
                self.blocks.clear()
            self.blocks[no] = _multipliers(no * STEPS, STEPS)
        return self.blocks[no]

    def digits(self, texts: list[str]) -> np.ndarray:
        """The digits of every text, WALKS x SLOTS of them a row."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        # Texts one after another, each with zeros behind it, where a walk stands still.
        begins = np.cumsum(sizes + GRAM) - (sizes + GRAM)
        letters = np.frombuffer("".join([texts[k] for k in order]).encode("utf-32-le"), dtype="<u4")
        signs = np.zeros(int((sizes + GRAM).sum()), dtype=np.uint64)
        signs[np.arange(len(letters)) + np.repeat(GRAM * np.arange(len(texts)), sizes)] = _mix(letters.astype(np.uint64)) | np.uint64(1)
        steps = 2 * sizes
        chosen = np.stack([r[np.searchsorted(r, np.maximum(steps, 1), side="left") - 1] for r in self.records], axis=1)
        at = self._pointers(signs, begins, steps, chosen)
        found = _random(5000, chosen * len(self.records) + np.arange(len(self.records)))
        for g in range(GRAM):
            found = _mix(found ^ signs[at + g])
        found = (found >> np.uint64(60)).astype(np.uint8)
        found[sizes == 0] = 0
        out = np.empty_like(found)
        out[order] = found
        return out

    def _pointers(self, signs: np.ndarray, begins: np.ndarray, steps: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Where each walk's pointer stands before each chosen step; texts come longest first."""
        walk_of = np.repeat(np.arange(WALKS), SLOTS)
        # The first walks end alone: only from there on are fewer than TOGETHER texts left.
        until = int(steps[TOGETHER]) if len(steps) > TOGETHER else 0
        active = np.searchsorted(-steps, -np.arange(1, until + 1), side="right")  # texts of at least so many steps
        firsts = np.concatenate([[0], np.cumsum(active)])
        trail = np.empty((int(firsts[-1]), WALKS), dtype=np.int32)
        now = np.repeat(begins[:, None], WALKS, axis=1)
        for first in range(0, until, STEPS):
            block = self._block(first // STEPS)
            for j in range(first, min(first + STEPS, until)):
                n = active[j]
                here = now[:n]
                trail[firsts[j] : firsts[j + 1]] = here
                bits = signs[here] * block[j - first]
                bits >>= np.uint64(63)
                here += bits.view(np.int64)
        at = np.zeros(chosen.shape, dtype=np.int64)
        rows = np.arange(len(steps))
        together = (chosen < until) & (steps > 0)[:, None]
        for w in range(WALKS):
            own = (walk_of == w) & together
            r, s = np.nonzero(own)
            at[r, s] = trail[firsts[chosen[r, s]] + rows[r], w]
        for k in np.flatnonzero(steps > until).tolist():
            for w in range(WALKS):
                slots = np.flatnonzero((walk_of == w) & (chosen[k] >= until))
                slots = slots[np.argsort(chosen[k, slots], kind="stable")]
                at[k, slots] = self._alone(signs, int(now[k, w]), w, until, chosen[k, slots].tolist())
        return at

    def _alone(self, signs: np.ndarray, at: int, walk: int, step: int, wanted: list[int]) -> list[int]:
        """One walk of one text, from a step on: the pointer before each wanted step, in order."""
        view, out = memoryview(signs), []
        no, block = -1, []
        for goal in wanted:
            while step < goal:
                if step // STEPS != no:
                    no = step // STEPS
                    block = self._block(no)[:, walk].tolist()
                end = min(goal, (no + 1) * STEPS)
                for m in block[step - no * STEPS : end - no * STEPS]:
                    at += (view[at] * m & MASK) >> 63
                step = end
            out.append(at)
        return out


def likeness(equal: np.ndarray, width: int) -> np.ndarray:
    """The share of equal digits, of so many, beyond what chance gives: 0 to 1."""
    return np.maximum(equal / width - 1 / 16, 0) / (15 / 16)


def _as_text(digits: np.ndarray) -> pa.Array:
    width = digits.shape[1]
    data = _HEX[digits].tobytes()
    return pa.array([data[k : k + width].decode() for k in range(0, len(data), width)], pa.string())


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in stretches of ascending id, each sorted and followed by the first document of the next.

    Columns ``guest`` (that document), ``id`` and ``text``; a stretch is a partition. Its
    bounds are quantiles of the ids; what comes to the driver is a number per stretch.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce("id", F.lit(NO_ID)))
    cuts = rows.agg(F.percentile_approx("at", [k / n for k in range(1, n)], 10_000).alias("q")).first().q if n > 1 else []
    cuts = sorted(set(cuts or []))
    # The number of cuts at or below an id, by halving: the list is filled up with ids none is beyond.
    width = 1 << len(cuts).bit_length()
    table = F.lit([*cuts, *[None] * (width - len(cuts))]).cast("array<bigint>") if cuts else F.array(F.lit(None).cast("bigint"))
    halves = [width >> k for k in range(1, width.bit_length())] or [0]

    def stretch(at):
        step = lambda below, s: F.when(F.element_at(table, (below + s).cast("int")) <= at, below + s).otherwise(below)
        return F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), step) if cuts else F.lit(0)

    rows = rows.withColumn("stretch", stretch(F.col("at")))
    heads = sorted(map(tuple, rows.groupBy("stretch").agg(F.min("at").alias("head")).collect()))
    before = {head: heads[k - 1][0] for k, (_, head) in enumerate(heads)}
    place = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(0), F.lit(0))
    firsts = rows.filter(F.col("at").isin(list(before))).groupBy("at").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    guests = firsts.select(F.lit(True).alias("guest"), F.lit(None).cast("long").alias("id"), "at", "text", place[F.col("at")].alias("stretch"))
    both = rows.select(F.lit(False).alias("guest"), "id", "at", "text", "stretch").unionByName(guests)
    dealt = both.repartitionById(n, F.col("stretch")).sortWithinPartitions("guest", "at", F.xxhash64("text"))
    return dealt.select("guest", "id", "text")


def edited(text: str, following: str) -> str:
    """The text with the last half of its characters replaced by as many of the next one's first, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


PRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
          "near_next double, text_sha256 string")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Every document's fingerprint and that of its edited text, its likeness to this and to the next document, and a hash of its text."""
    names = [c.split()[0] for c in PRINTS.split(", ")]

    def walk(batches):
        embedder, ids, texts, chars = Embedder(), [], [], 0

        def rows():
            """All but the last text, which is only the next one of its predecessor."""
            own, changed = texts[:-1], [edited(t, u) for t, u in zip(texts, texts[1:])]
            digits = embedder.digits([*texts, *changed])
            mine, following, new = digits[: len(own)], digits[1 : len(texts)], digits[len(texts) :]
            values = [
                pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), _as_text(mine), _as_text(new),
                *(pa.array(likeness((mine == d).sum(axis=1), mine.shape[1])) for d in (new, following)),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in own])]
            return pa.record_batch(values, names=names)

        for batch in batches:
            for guest, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if guest and not ids:
                    continue  # of a stretch without documents
                ids.append(doc)
                texts.append(text.as_py())
                chars += len(texts[-1]) + 1
                if len(ids) > 1 and chars >= slice_chars or guest:
                    yield rows()
                    ids, texts, chars = ids[-1:], texts[-1:], len(texts[-1])

    return with_next(docs, id_col, text_col).mapInArrow(walk, PRINTS)


def band_places(band: int, width: int) -> np.ndarray:
    """The digits that a band samples."""
    return np.argsort(_random(9000 + band, np.arange(width)), kind="stable")[:BAND]


def _alike(digits: np.ndarray, band: int, least: float) -> np.ndarray:
    """Which members of a tile are alike and meet in no earlier band, as a matrix."""
    n, width = digits.shape
    if n <= 64:
        equal = (digits[:, None, :] == digits[None, :, :]).sum(axis=2)
    else:
        equal = reduce(np.add, ((digits[:, k, None] == digits[None, :, k]).astype(np.int16) for k in range(width)))
    alike = likeness(equal, width) >= least
    np.fill_diagonal(alike, False)
    r, s = np.nonzero(alike)
    for b in range(band):
        own = band_places(b, width)
        before = (digits[r][:, own] == digits[s][:, own]).all(axis=1)
        alike[r[before], s[before]] = False
        r, s = r[~before], s[~before]
    return alike


def _forest(nodes: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """The least node each node of a tile is tied to, through others too."""
    root = nodes.copy()
    while True:
        least = np.minimum(root, np.where(alike, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if np.array_equal(least, root):
            return root
        root = least


def links(nodes: DataFrame, least: float = LEAST, tile: int = TILE) -> DataFrame:
    """``node``, ``tied`` and ``n_links`` for nodes alike to others: per tile, the number of partners and a node it is tied to.

    ``nodes`` has ``node``, a long without repeats, and ``fingerprint``; it is read more than once.
    """

    def cut(batches):
        for batch in batches:
            digits = _digits(batch.column(1))
            node = batch.column(0).to_numpy()
            for b in range(BANDS):
                keys = np.ascontiguousarray(digits[:, band_places(b, digits.shape[1])] if len(digits) else np.empty((0, BAND), np.uint8))
                key = reduce(lambda h, k: _mix(h ^ keys[:, k]), range(BAND), _random(7000 + b, np.zeros(len(keys))))
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(np.full(len(keys), b, np.int32)), pa.array(node)], names=["bucket", "band", "node"])

    buckets = nodes.select("node", "fingerprint").mapInArrow(cut, "bucket long, band int, node long")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / tile).cast("int")
    members = buckets.join(shared, "bucket").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # A pair of parts is a tile; a part is sent to the tiles it has with every other.
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least("part", k).alias("i"), F.greatest("part", k).alias("j")))
    placed = members.withColumn("t", F.explode(meets)).select("bucket", "band", "node", F.col("t.i").alias("i"), F.col("t.j").alias("j"), "part")
    full = placed.join(nodes.select("node", "fingerprint"), "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def compare(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            key = [table.column(n).to_numpy() for n in ("bucket", "i", "j")]
            cuts = (np.flatnonzero(reduce(np.logical_or, (k[1:] != k[:-1] for k in key))) + 1).tolist()
            yield from results(table, [0, *cuts])
            held = table.slice(cuts[-1] if cuts else 0)
        if held is not None:
            yield from results(held, [0, held.num_rows])

    def results(table, cuts):
        digits, node, part, i, j, band = _digits(table.column("fingerprint").combine_chunks()), *(table.column(n).to_numpy() for n in ("node", "part", "i", "j", "band"))
        out = []
        for a, b in zip(cuts, cuts[1:]):
            alike = _alike(digits[a:b], int(band[a]), least)
            if i[a] != j[a]:  # pairs within a part are the business of the part's own tile
                alike &= part[a:b, None] != part[None, a:b]
            n = alike.sum(axis=1)
            tied = _forest(node[a:b], alike)
            out.append(np.stack([node[a:b], tied, n])[:, n > 0])
        made = np.concatenate(out, axis=1) if out else np.empty((3, 0), np.int64)
        yield pa.record_batch([pa.array(c) for c in made], names=["node", "tied", "n_links"])

    chosen = full.select("bucket", "i", "j", "part", "band", "node", "fingerprint")
    return chosen.mapInArrow(compare, "node long, tied long, n_links long")


def _digits(prints: pa.Array) -> np.ndarray:
    data = np.frombuffer("".join(prints.to_pylist()).encode(), dtype=np.uint8)
    return np.where(data >= 97, data - 87, data - 48).reshape(len(prints), -1) if len(prints) else np.empty((0, WALKS * SLOTS), np.uint8)


def near_duplicates(prints: DataFrame, least: float = LEAST, tile: int = TILE) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_links`` of every row of :func:`fingerprints`.

    Two texts are linked if a band brings them together and their likeness is ``least`` or
    more; ``n_links`` counts the other texts linked to a row's text, however many copies
    these have. ``class_id`` is the smallest id among all texts reachable by links.
    """
    prints = materialise(prints.select("doc_id", F.xxhash64("text_sha256").alias("node"), "fingerprint"))
    nodes = materialise(prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("fingerprint").alias("fingerprint")))
    found = materialise(links(nodes, least, tile))
    roots = connected(found.select(F.col("node").alias("a"), F.col("tied").alias("b")))
    numbers = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    known = nodes.select("node", "first").join(roots, "node", "left").join(numbers, "node", "left")
    known = materialise(known.select("node", "first", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    classes = known.join(known.groupBy("root").agg(F.min("first").alias("class_id")), "root")
    return prints.select("doc_id", "node").join(classes.select("node", "class_id", "n_links"), "node").drop("node")
