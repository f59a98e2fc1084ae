"""Benchmark decontamination with a broadcast hash set of test n-grams.

The windows of the benchmark items (``N`` consecutive words; an item with fewer is one
window) are gathered, measured, and broadcast if they take at most ``MAX_BYTES``. A task
turns the words of its documents into numbers, hashes every window of a document by
arrays, looks the hashes up, and verifies each hit word by word. A larger benchmark is
broadcast in blocks of that size, one pass over the documents each, whose findings are
carried along as columns; no document is shuffled either way. Passages are cut after the
last pass, so the number of blocks makes no difference.

Defined cases: null, empty and word-free texts have no words and no hits; items that are
null or word-free have no windows; items repeated under one id count once; a null item id
counts as the empty string; empty tables give no hits. Other columns are not read, and
:func:`decontaminate` returns those of its input untouched.
"""

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import alnum_word_spans, alnum_words
from rollcall.operators.small_tables import materialise

N = 13
MAX_BYTES = 64 * 1024 * 1024
_SLICE_WORDS = 500_000
SPANS = "array<struct<start:long,end:long>>"
FOUND = f"id long, row long, n_words long, spans {SPANS}, items array<string>"


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = N) -> DataFrame:
    """``item`` and ``gram``: every window of every item, without repeats."""

    def cut(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = alnum_words(text)
                grams = {b" ".join(words[i : i + n]).decode() for i in range(max(1, len(words) - n + 1))} if words else ()
                yield pa.record_batch([pa.array([item] * len(grams), pa.string()), pa.array(list(grams), pa.string())], names=["item", "gram"])

    chosen = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(cut, "item string, gram string").distinct()


class Grams:
    """Hash set of windows over numbered words; lives in one task."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.items: dict[bytes, list[str]] = defaultdict(list)
        for item, gram in rows:
            self.items[gram.encode()].append(item)
        self.number: dict[bytes, int] = {}
        for gram in self.items:
            for word in gram.split(b" "):
                self.number.setdefault(word, len(self.number) + 1)
        by_length: dict[int, list[int]] = defaultdict(list)
        for gram in self.items:
            ids = [self.number[w] for w in gram.split(b" ")]
            by_length[len(ids)].append(int(self._hashes(np.array(ids, dtype=np.uint64), len(ids))[0]))
        self.hashes = {k: np.unique(np.array(v, dtype=np.uint64)) for k, v in by_length.items()}

    def _hashes(self, ids: np.ndarray, length: int) -> np.ndarray:
        total, power = np.zeros(len(ids) - length + 1, dtype=np.uint64), 1
        for j in range(length):
            total += ids[j : len(ids) - length + 1 + j] * np.uint64(power)
            power = power * self.BASE % (1 << 64)
        return total

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; 0 for a word of no window."""
        return np.fromiter(map(self.number.get, words, repeat(0)), dtype=np.uint64, count=len(words))

    def starts(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Places and lengths where a window may stand: all its words known, its hash too."""
        known = np.concatenate(([0], np.cumsum(ids != 0)))
        found = []
        for length, hashes in self.hashes.items():
            if len(ids) >= length:
                full = np.flatnonzero(known[length:] - known[:-length] == length)
                if len(full):
                    total = np.zeros(len(full), dtype=np.uint64)
                    power = 1
                    for j in range(length):
                        total += ids[full + j] * np.uint64(power)
                        power = power * self.BASE % (1 << 64)
                    found += [(int(i), length) for i in full[np.isin(total, hashes)]]
        return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_in(texts: list, grams: Grams) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: words, merged hit spans in words, and items hit."""
    out = []
    at = 0
    while at < len(texts):
        docs, total = [], 0
        while at < len(texts) and (not docs or total < _SLICE_WORDS):
            docs.append(alnum_words(texts[at]))
            total += len(docs[-1]) + 1
            at += 1
        sizes = np.array([len(d) + 1 for d in docs])
        firsts = np.cumsum(sizes) - sizes
        ids = grams.numbers([w for d in docs for w in (*d, b" ")])  # a blank is no word: no window spans two texts
        hits: dict[int, tuple[list, set]] = {}
        for place, length in grams.starts(ids):
            k = int(np.searchsorted(firsts, place, side="right")) - 1
            start = place - int(firsts[k])
            if items := grams.items.get(b" ".join(docs[k][start : start + length])):
                spans, names = hits.setdefault(k, ([], set()))
                spans.append((start, start + length))
                names.update(items)
        for k, d in enumerate(docs):
            spans, names = hits.get(k, ([], set()))
            out.append((len(d), _merged(spans), names))
    return out


def _blocks(grams: DataFrame, max_bytes: int) -> list[DataFrame]:
    """The windows in parts of at most about ``max_bytes``; one part if they fit."""
    size = grams.agg(F.sum(F.octet_length("gram") + F.octet_length("item") + 200)).first()[0] or 0
    n = -(-size // max_bytes) or 1
    return [grams.filter(F.pmod(F.xxhash64("gram"), F.lit(n)) == i) for i in range(n)] if n > 1 else [grams]


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         n: int = N, max_bytes: int = MAX_BYTES, item_col: str = "item_id") -> DataFrame:
    """Per document ``id``, ``row``, ``n_words``, hit ``spans`` (words, merged) and ``items``."""
    context = docs.sparkSession.sparkContext
    grams = materialise(windows(benchmark, item_col, "text", n))
    blocks = _blocks(grams, max_bytes)
    now = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row"), F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {SPANS})").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"), F.col(text_col).alias("text"),
    )
    for k, block in enumerate(blocks):
        sent = context.broadcast([(r.item, r.gram) for r in block.collect()])  # at most max_bytes
        last = k == len(blocks) - 1

        def find(batches, sent=sent, last=last):
            grams = Grams(sent.value)
            for b in batches:
                texts = b.column(5)
                rows = find_in(texts.to_pylist(), grams)
                spans = [_merged([(s["start"], s["end"]) for s in old] + new) for old, (_, new, _) in zip(b.column(3).to_pylist(), rows)]
                items = [sorted({*old, *new}) for old, (_, _, new) in zip(b.column(4).to_pylist(), rows)]
                columns = [
                    b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ]
                names = ["id", "row", "n_words", "spans", "items"]
                yield pa.record_batch(columns if last else [*columns, texts], names=names if last else [*names, "text"])

        now = now.mapInArrow(find, FOUND if last else FOUND + ", text string")
        if not last:
            now = materialise(now)
    return now


def verdicts(found: DataFrame) -> DataFrame:
    """``n_hit``, ``n_items`` and ``contaminated``: hit words are a twentieth or more."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given spans of words."""
    places = alnum_word_spans(text)
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", text_col: str = "text",
                  n: int = N, max_bytes: int = MAX_BYTES, item_col: str = "item_id") -> DataFrame:
    """``docs`` without contaminated documents, or (mode "span") with all hit passages cut out."""
    if mode not in ("document", "span"):
        raise ValueError(f"mode {mode!r} is neither 'document' nor 'span'")
    context = docs.sparkSession.sparkContext
    blocks = _blocks(materialise(windows(benchmark, item_col, "text", n)), max_bytes)
    place, width = docs.columns.index(text_col), len(docs.columns)
    if len(blocks) > 1 and mode == "document":
        # Hits of all blocks count together, so the verdict comes after the last pass.
        found = verdicts(scan(docs.withColumn("_rollcall_id", F.lit(None).cast("long")), benchmark, "_rollcall_id", text_col, n, max_bytes, item_col))
        bad = found.filter("contaminated").select(F.col("row").alias("_rollcall_row")).distinct()
        return docs.withColumn("_rollcall_text", F.xxhash64(text_col)).join(bad, F.col("_rollcall_text") == F.col("_rollcall_row"), "left_anti").drop("_rollcall_text")
    now = docs if len(blocks) == 1 else docs.withColumn("_rollcall_spans", F.expr(f"cast(array() as {SPANS})"))
    carried = now.schema
    for k, block in enumerate(blocks):
        sent = context.broadcast([(r.item, r.gram) for r in block.collect()])  # at most max_bytes
        last = k == len(blocks) - 1

        def clean(batches, sent=sent, last=last):
            grams = Grams(sent.value)
            for b in batches:
                texts = b.column(place).to_pylist()
                rows = find_in(texts, grams)
                if mode == "document":
                    hit = [sum(e - s for s, e in spans) for _, spans, _ in rows]
                    yield b.filter(pa.array([not (h and 20 * h >= r[0]) for h, r in zip(hit, rows)], pa.bool_()))
                    continue
                found = [spans for _, spans, _ in rows]
                if len(carried) > width:
                    before = b.column(width).to_pylist()
                    found = [_merged([(s["start"], s["end"]) for s in old] + spans) for old, spans in zip(before, found)]
                if last:
                    new = [_cut(t, spans) if spans else t for t, spans in zip(texts, found)]
                    b = b.set_column(place, b.schema.field(place), pa.array(new, b.schema.field(place).type))
                    yield b.select(list(range(width)))
                else:
                    spans = [[{"start": s, "end": e} for s, e in x] for x in found]
                    yield b.set_column(width, b.schema.field(width), pa.array(spans, b.schema.field(width).type))

        now = now.mapInArrow(clean, docs.schema if last else carried)
        if not last:
            now = materialise(now)
    return now
