"""Byte-level BPE by a global shuffle of distinct words, and decoding by the byte table.

1. A task splits its documents into pre-tokens and numbers the distinct ones of a batch
   of documents (at most ``BATCH_CHARS`` of text, or one longer document) in order of
   appearance. A document becomes the positions of its pre-tokens: a list of numbers.
2. The words of each batch are dealt to buckets by their hash. A bucket receives its
   words from all batches and encodes each distinct one once, by the merge ranks; beyond
   ``REMEMBERED`` words it forgets what it had, so that its memory is bounded.
3. The ids return to their batches, which are joined by key with the positions, and the
   documents are put together again in order.

So a word occurring in a third of all places travels once per batch, not once per
occurrence, and no group is larger than a batch or a bucket; the number of buckets is
the number of shuffle partitions. A batch is keyed by its task's partition, its number in
the task and its word list: batches of equal words, as of copies that lie together, stay
apart. A task that is computed again makes the same keys, and a batch without its ids is
an error, never a shorter result.

Decoding joins every id with the token-byte table, broadcast: it has one row per id of
the vocabulary, whatever the data.

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows and
ids are rows of their own; an empty table gives an empty result. Other columns are not
read. Ids that are not in the vocabulary raise an error when decoded.
"""

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_CHARS = 24_000_000
_SPLIT_CACHE = 200_000
REMEMBERED = 400_000
PARTS = "key binary, bucket int, words array<string>, docs array<long>, sizes binary, order binary, positions binary"
NAMES = ["key", "bucket", "words", "docs", "sizes", "order", "positions"]
TYPES = [pa.binary(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from the text of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as four byte planes, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


class Splitter:
    """Numbers the pre-tokens of a batch of texts."""

    def __init__(self, pattern: str) -> None:
        self.find = regex.compile(pattern).findall
        self.start()

    def start(self) -> None:
        self.words: dict[str, int] = {}
        self.pieces: dict[str, tuple[int, ...] | None] = {}

    def _numbers(self, text: str) -> tuple[int, ...]:
        words = self.words
        return tuple([words.setdefault(w, len(words)) for w in self.find(text)])

    def split(self, text: str) -> np.ndarray:
        """The text's pre-tokens by number.

        Between two characters that are not white space, a single space always begins a
        pre-token, so such pieces are split once and remembered. A text with any other
        space is split as a whole.
        """
        if not text:
            return np.empty(0, dtype=np.uint32)
        known, out = self.pieces, []
        first, *rest = text.split(" ")
        if rest and (not first or first[-1].isspace()):
            return np.array(self._numbers(text), dtype=np.uint32)
        for p in rest:
            numbers = known.get(p, 0)
            if numbers == 0:
                edges = not p or p[0].isspace() or p[-1].isspace()
                numbers = None if edges else self._numbers(" " + p)
                if len(known) < _SPLIT_CACHE:
                    known[p] = numbers
            if numbers is None:
                return np.array(self._numbers(text), dtype=np.uint32)
            out.append(numbers)
        return np.array([*self._numbers(first), *chain.from_iterable(out)], dtype=np.uint32)


def _bucket_of(words: list[str], buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), dtype=np.uint32, count=len(words))


def _parts(docs: DataFrame, pattern: str, buckets: int, want: str) -> DataFrame:
    """Rows of batches: "words" gives one per bucket, "positions" one per batch."""

    def cut(batches):
        splitter = Splitter(pattern)
        ids, found, chars = [], [], 0
        partition, number = TaskContext.get().partitionId(), 0

        def rows():
            words = list(splitter.words)
            lengths = np.array([len(w) for w in words], dtype="<u4")
            digest = xxhash.xxh3_128(np.array([partition, number], dtype="<u8").tobytes())
            digest.update(lengths.tobytes())
            digest.update("".join(words).encode())
            key = digest.digest()
            bucket = _bucket_of(words, buckets)
            order = np.argsort(bucket, kind="stable")
            if want == "positions":
                sizes = np.array([len(f) for f in found], dtype="<u4")
                values = [key, None, None, ids, _pack(sizes), _pack(order), _pack(np.concatenate(found))]
                yield pa.record_batch([pa.array([v], t) for v, t in zip(values, TYPES)], names=NAMES)
                return
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            for k, end in enumerate(ends):
                begin = ends[k - 1] if k else 0
                if end > begin:
                    own = [words[i] for i in order[begin:end]]
                    yield pa.record_batch([pa.array([v], t) for v, t in zip([key, k, own, None, None, None, None], TYPES)], names=NAMES)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids.append(doc)
                found.append(splitter.split(text))
                chars += len(text) + 1
                if chars >= BATCH_CHARS:
                    yield from rows()
                    splitter.start()
                    ids, found, chars, number = [], [], 0, number + 1
        if ids:
            yield from rows()

    return docs.mapInArrow(cut, PARTS)


def _encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit numbers) of every document.

    ``ranks`` is the text of a rank file, ``pattern`` splits texts into pre-tokens.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(ranks)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    words = _parts(chosen, pattern, buckets, "words").select("key", "bucket", "words").repartitionById(buckets, F.col("bucket"))

    def encode_words(batches):
        encoding = _encoder(sent.value, pattern)
        known: dict[str, bytes] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                own = row.column(2)[0].as_py()
                if len(known) > REMEMBERED:  # the words of one batch more, whatever the bucket holds
                    known.clear()
                for w in own:
                    if w not in known:
                        known[w] = np.array(encoding.encode_ordinary(w), dtype="<u4").tobytes()
                ids = [known[w] for w in own]
                sizes = np.array([len(i) // 4 for i in ids], dtype="<u4")
                yield pa.record_batch(
                    [row.column(0), row.column(1), pa.array([_pack(sizes)]), pa.array([_pack(np.frombuffer(b"".join(ids), dtype="<u4"))])],
                    names=["key", "bucket", "sizes", "ids"],
                )

    coded = words.mapInArrow(encode_words, "key binary, bucket int, sizes binary, ids binary")
    placed = _parts(chosen, pattern, buckets, "positions").select("key", "docs", "sizes", "order", "positions")

    def put_together(key, left, right):
        # A key stands for one batch: one row of positions, and one of ids for each bucket that has its words.
        parts = {b: (s, i) for b, s, i in zip(*(right.column(n).to_pylist() for n in ("bucket", "sizes", "ids")))}
        in_order = [parts[b] for b in sorted(parts)]
        sizes = np.concatenate([np.empty(0, "<u4"), *[_unpack(s) for s, _ in in_order]]).astype(np.int64)
        ids = np.concatenate([np.empty(0, "<u4"), *[_unpack(i) for _, i in in_order]])
        begins = np.cumsum(sizes) - sizes
        for at in range(left.num_rows):
            row = {n: left.column(n)[at].as_py() for n in ("docs", "sizes", "order", "positions")}
            order = _unpack(row["order"])
            if len(order) != len(sizes):
                raise ValueError("a batch of words came back incomplete")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            positions, ends = _unpack(row["positions"]), np.cumsum(_unpack(row["sizes"]).astype(np.int64))
            for first in range(0, len(row["docs"]), 200):
                some = row["docs"][first : first + 200]
                out = []
                for k in range(first, first + len(some)):
                    at_word = place[positions[ends[k - 1] if k else 0 : ends[k]]]
                    n = sizes[at_word]
                    stops = np.cumsum(n)
                    out.append(ids[np.repeat(begins[at_word] - (stops - n), n) + np.arange(n.sum())].tobytes())
                yield pa.table({"doc_id": pa.array(some, pa.int64()), "ids": pa.array(out, pa.binary())})

    def whole(key, left, right):
        made = list(put_together(key, left, right))
        return pa.concat_tables(made) if made else pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.binary())})

    return placed.groupBy("key").cogroup(coded.groupBy("key")).applyInArrow(whole, "doc_id long, ids binary")


def decode(coded: DataFrame, ranks: bytes) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``."""
    sent = coded.sparkSession.sparkContext.broadcast(ranks)

    def to_bytes(batches):
        table = {rank: token for token, rank in read_ranks(sent.value).items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                decoded = [b"".join(map(table.__getitem__, np.frombuffer(i, dtype="<u4").tolist())) for i in part.column(1).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    return coded.select("doc_id", "ids").mapInArrow(to_bytes, "doc_id long, ids binary, decoded binary")
