"""Two tokenizers' ids of one text, cut into groups at the byte offsets where both end.

Both tokenizers read a space and the text: a byte-level BPE (A) is given it, a piece BPE
(B) adds it by itself. A task encodes its documents by their distinct units, lays the end
offsets of both sides of a slice of documents end to end, and aligns these two arrays by
diagonal run skipping: while the ends at ``i`` and ``i + shift`` agree, probes of doubling
length compare the two arrays at the current shift and jump over whole stretches of
one-to-one tokens; an irregular group is resolved locally by advancing the side that is
behind, and the shift is updated. Ends of documents are ends of both sides, so no group
crosses them.

Every group ends with one pair of occurrences whose bytes end together, its link. How
often the corpus links a pair of ids is counted exactly: a batch of documents (at most
``BATCH_CHARS`` of text, or one longer document) is one row of the written table, with its
distinct pairs and their numbers beside it, and the place among these of every link in as
few bytes as they need; these are summed by pair, set beside the
highest sum of their B id, joined back to the batches they come from, and read off per
document. A pair in a third of all places travels once per batch. Only the highest sums
are broadcast, a row per id of B's vocabulary at most.

Units are the parts of a text between single spaces that have no white space beside them.
Byte-level splitting never joins ids across such a space, and neither does B, if none of
its pieces holds a space behind another character; else a text is one unit.

Defined cases: null and empty texts, and texts whose joined bytes of A or of B differ from
a space and the text (as by U+2581, which B reads as a space), have no tokens: numbers are
zero and the groups an empty text. Repeated rows and ids are rows of their own, and their
links count each. An empty table gives an empty result. Other columns are not read. Long
texts take memory in proportion to their own length.
"""

import hashlib
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.arrow import batches_of
from rollcall.llm.token_files import Encoder, gather
from rollcall.operators.small_tables import materialise

BATCH_CHARS = 2_000_000
SLICE_CHARS = 250_000
REMEMBERED = 80_000
LISTED = 2_000_000
ROWS_AT_ONCE = 1_000
_JOINT = re.compile(r"(?<=\S) (?=\S)")
BATCHES = ("key long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups array<string>, "
           "pairs array<long>, counts array<long>, links binary")
BATCH_TYPES = [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.list_(pa.large_string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.large_binary()]
BATCH_NAMES = [c.split()[0] for c in BATCHES.split(", ")]
#: Sizes are looked at after each batch, not after 100, so that row groups hold a few and pages one: the writer holds a row
#: group, the reader the arrays of one and a page of each column, however many batches a task has made.
WRITTEN = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}


def align_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of every value they share; both ascend without repeats."""
    a, b = np.ascontiguousarray(a, dtype="<i8"), np.ascontiguousarray(b, dtype="<i8")
    a_bytes, b_bytes = a.tobytes(), b.tobytes()
    # Single ends are read from lists, or from the arrays themselves where lists would be large.
    a_at, b_at = (x.tolist() if len(x) <= LISTED else memoryview(x) for x in (a, b))
    i, j, n_a, n_b = 0, 0, len(a), len(b)
    starts, shifts, lengths = [], [], []
    while i < n_a and j < n_b:
        x, y = a_at[i], b_at[j]
        if x < y:  # an irregular group: the side behind goes on
            i += 1
            continue
        if x > y:
            j += 1
            continue
        # On a common end: probe ahead at this shift, each time twice as far, then closer again.
        p, q, room = i + 1, j + 1, min(n_a - i, n_b - j) - 1
        if room and a_at[p] == b_at[q]:
            p, q, room, step = p + 1, q + 1, room - 1, 2
            while step <= room and a_bytes[8 * p : 8 * (p + step)] == b_bytes[8 * q : 8 * (q + step)]:
                p, q, room, step = p + step, q + step, room - step, 2 * step
            while step > 1:
                step //= 2
                if step <= room and a_bytes[8 * p : 8 * (p + step)] == b_bytes[8 * q : 8 * (q + step)]:
                    p, q, room = p + step, q + step, room - step
        starts.append(i)
        shifts.append(j - i)
        lengths.append(p - i)
        i, j = p, q
    n = np.array(lengths, dtype=np.int64)
    at_a = np.repeat(np.array(starts, dtype=np.int64) - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return at_a, at_a + np.repeat(np.array(shifts, dtype=np.int64), n)


class TwoTokenizers:
    """Ids of units by both tokenizers, and the bytes of every id."""

    def __init__(self, a_json: bytes, a_pattern: str, b_model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(a_json, a_pattern, remembered=REMEMBERED)
        self.b = SentencePieceProcessor(model_proto=b_model)
        letters = {letter: bytes([byte]) for byte, letter in self.a.letters.items()}
        entries = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, no in entries.items():
            self.a_bytes[no] = b"".join(letters.get(c, c.encode()) for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)]
        self.apart = not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes))
        self.start()
        self.a_table, self.b_table = (pa.array(t, pa.large_binary()) for t in (self.a_bytes, self.b_bytes))
        # Every id of A and of B as text with each sign that may stand behind it.
        signs = [[f"{i}{s}" for i in range(len(t))] for t, over in ((self.a_bytes, ",|"), (self.b_bytes, (",", ";", ""))) for s in over]
        self.written = pa.array([x for part in signs for x in part], pa.large_string())

    def units(self, text: str) -> list[str]:
        return _JOINT.split(text) if self.apart else [text]

    def start(self) -> None:
        """Forget the units met so far."""
        nothing = np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        self.number: dict[str, int] = {}
        self.sides, self.fits = [nothing, nothing], np.empty(0, dtype=bool)

    def numbered(self, texts: list[str | None]) -> list[np.ndarray]:
        """The units of each text by number; new ones are encoded and remembered."""
        if len(self.number) > REMEMBERED:
            self.start()
        number, known = self.number, len(self.number)
        of_text = [np.array([number.setdefault(u, len(number)) for u in self.units(t)] if t else [], dtype=np.int64) for t in texts]
        sides, fits = self.encode(list(islice(number, known, None)))
        self.sides = [tuple(np.concatenate(x) for x in zip(old, new)) for old, new in zip(self.sides, sides)]
        self.fits = np.concatenate([self.fits, fits])
        return of_text

    def encode(self, units: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Ids and their numbers by A of a space and each unit and by B of each unit, and which units both give back."""
        found = self.b.encode(units, num_threads=1) if units else []
        counts = np.array([len(f) for f in found], dtype=np.int64)
        sides = [self.a.encode_spaced(units), (np.fromiter(chain.from_iterable(found), "<u4", count=int(counts.sum())), counts)]
        whole = [(" " + u).encode() for u in units]
        lengths = np.array([len(w) for w in whole], dtype=np.int64)
        joined, fits = b"".join(whole), np.ones(len(units), dtype=bool)
        for (ids, counts), table, sizes in zip(sides, (self.a_table, self.b_table), (self.a_sizes, self.b_sizes)):
            made = bytes(table.take(pa.array(ids.astype(np.int64))).buffers()[2] or b"")
            upto = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
            if not np.array_equal(np.diff(upto), lengths) or made != joined:
                fits &= np.array([made[x:y] == w for x, y, w in zip(upto, upto[1:], whole)], dtype=bool)
        return sides, fits

    def gives_back(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        whole = (" " + text).encode()
        return all(b"".join(map(t.__getitem__, ids.tolist())) == whole for t, ids in ((self.a_bytes, a), (self.b_bytes, b)))


def _tokens(both: TwoTokenizers, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids by A and by B of all texts, one after another, and how many each text has."""
    of_text = both.numbered(texts)
    sides, fits = both.sides, both.fits
    for k, units in enumerate(of_text):
        if not fits[units].all() and not both.gives_back(texts[k], *(gather(ids, sizes, units) for ids, sizes in sides)):
            of_text[k] = units[:0]
    order = np.concatenate([np.empty(0, np.int64), *of_text])
    ends = np.cumsum([len(u) for u in of_text])
    out = []
    for ids, sizes in sides:
        upto = np.concatenate([[0], np.cumsum(sizes[order])])
        out += [gather(ids, sizes, order), np.diff(upto[np.concatenate([[0], ends]).astype(np.int64)])]
    return out[0], out[2], out[1], out[3]


def _written_groups(both: TwoTokenizers, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, last: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The groups of all documents as one text, and where each token's part of it begins; ``last`` marks the groups that end a document."""
    n_a, n_b = len(both.a_bytes), len(both.b_bytes)
    groups = np.arange(len(at_a))
    of_a, of_b = (np.repeat(groups, np.diff(at, prepend=-1)) for at in (at_a, at_b))
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    sign_a, sign_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    sign_a[at_a] = 1
    sign_b[at_b] = np.where(last, 2, 1)
    b_before = np.concatenate([[0], at_b[:-1] + 1])
    codes[np.arange(len(a)) + b_before[of_a]] = sign_a * n_a + a
    codes[np.arange(len(b)) + at_a[of_b] + 1] = 2 * n_a + sign_b * n_b + b
    text = both.written.take(pa.array(codes))
    return memoryview(text.buffers()[2] or b""), np.frombuffer(text.buffers()[1], dtype="<i8", count=len(text) + 1)


def _aligned_slice(both: TwoTokenizers, texts: list[str | None], digest: bool) -> tuple[list[np.ndarray], list[str], np.ndarray]:
    """Per text the numbers of A tokens, B tokens and groups; its groups as text or their digest; the linked pairs of all."""
    a, b, n_a, n_b = _tokens(both, texts)
    if not len(a):
        nothing = np.zeros(len(texts), dtype=np.int64)
        return [n_a, n_b, nothing], [""] * len(texts), np.empty(0, dtype=np.int64)
    at_a, at_b = align_ends(np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b]))
    ends = np.searchsorted(at_a, np.cumsum(n_a) - 1, side="right")
    n_groups = np.diff(ends, prepend=0)
    last = np.zeros(len(at_a), dtype=bool)
    last[ends[n_groups > 0] - 1] = True
    data, places = _written_groups(both, a, b, at_a, at_b, last)
    cuts = places[np.concatenate([[0], np.cumsum(n_a + n_b)])]
    parts = [data[x:y] for x, y in zip(cuts, cuts[1:])]
    groups = ["" if not len(p) else hashlib.sha256(p).hexdigest() if digest else bytes(p).decode() for p in parts]
    return [n_a, n_b, n_groups], groups, (a[at_a].astype(np.int64) << 32) | b[at_b]


def _packed(places: np.ndarray, n: int) -> bytes:
    """Numbers below ``n``, each in 1, 2 or 4 bytes."""
    return places.astype(next(t for t, most in (("<u1", 1 << 8), ("<u2", 1 << 16), ("<u4", 1 << 32)) if n <= most)).tobytes()


def _unpacked(data: pa.Buffer, count: int) -> np.ndarray:
    """``count`` numbers written by :func:`_packed`."""
    return np.frombuffer(data, dtype=f"<u{data.size // count}") if count else np.empty(0, dtype="<u4")


def align(docs: DataFrame, a_json: bytes, a_pattern: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False, batch_chars: int = BATCH_CHARS, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups`` of every document.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3`` with the ids in order, or its SHA-256 with
    ``digest``. ``n_best`` counts the links whose pair is the corpus's most frequent, or
    one of them, for its B id; ``count_sum`` adds up how often the corpus has each link's pair.
    """
    with batches_of(docs.sparkSession, ROWS_AT_ONCE):
        batches = materialise(_batches(docs, a_json, a_pattern, b_model, id_col, text_col, digest, batch_chars, slice_chars), **WRITTEN)
    pairs = batches.select(F.col("key").alias("batch"), F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("batch", "p.pairs", "p.counts")
    totals = pairs.groupBy("pairs").agg(F.sum("counts").alias("total"))
    b_id = F.col("pairs").bitwiseAND(0xFFFFFFFF)
    top = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("top"))
    judged = totals.join(F.broadcast(top), b_id == F.col("b")).select("pairs", "total", (F.col("total") == F.col("top")).alias("best"))
    back = pairs.select("batch", "pairs").join(judged, "pairs")

    def read_off(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, total, best = (right.column(n).to_numpy() for n in ("pairs", "total", "best"))
        order = np.argsort(pairs)
        out = []
        for row in left.to_batches():
            for k in range(row.num_rows):
                get = lambda n: row.column(BATCH_NAMES.index(n))[k].values
                own = get("pairs").to_numpy()
                place = order[np.searchsorted(pairs, own, sorter=order)] if len(own) else np.empty(0, np.int64)
                if not np.array_equal(pairs[place], own):
                    raise ValueError("a batch of links came back incomplete")
                n = get("n_groups").to_numpy()
                links = _unpacked(row.column(BATCH_NAMES.index("links"))[k].as_buffer(), int(n.sum()))
                ends = np.concatenate([[0], np.cumsum(n)])
                sums = [np.concatenate([[0], np.cumsum(x[place][links].astype(np.int64))])[ends] for x in (best, total)]
                columns = [*(get(c) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_groups")), *(pa.array(np.diff(s)) for s in sums), get("groups")]
                out.append(pa.table(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]))
        return pa.concat_tables(out)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return batches.groupBy("key").cogroup(back.groupBy("batch")).applyInArrow(read_off, schema)


def _batches(docs: DataFrame, a_json: bytes, a_pattern: str, b_model: bytes, id_col: str, text_col: str, digest: bool,
             batch_chars: int, slice_chars: int) -> DataFrame:
    """One row per batch of documents. Keys are only compared within one written table."""
    sent = docs.sparkSession.sparkContext.broadcast((a_json, b_model))

    def cut(batches):
        both = TwoTokenizers(sent.value[0], a_pattern, sent.value[1])
        task, number = TaskContext.get().partitionId(), 0
        ids, texts, done, chars, held = [], [], [], 0, 0

        def row():
            pairs, links, counts = np.unique(np.concatenate([d[2] for d in done]), return_inverse=True, return_counts=True)
            values = [(task << 32) + number, ids, *(np.concatenate([d[0][k] for d in done]) for k in range(3)),
                      [g for d in done for g in d[1]], pairs, counts, _packed(links, len(pairs))]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, BATCH_TYPES)], names=BATCH_NAMES)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                texts.append(text.as_py())
                held += len(texts[-1] or "") + 1
                if held >= slice_chars:
                    done.append(_aligned_slice(both, texts, digest))
                    texts, chars, held = [], chars + held, 0
                if chars >= batch_chars:
                    yield row()
                    ids, done, chars, number = [], [], 0, number + 1
        if texts:
            done.append(_aligned_slice(both, texts, digest))
        if ids:
            yield row()

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(cut, BATCHES)
