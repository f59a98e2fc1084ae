"""Token ids in bit planes: documents to id files, and back.

Documents are dealt by ranges of their id, so a shard holds a stretch of the order and
its place in the whole is a sum over the shards before it. A task encodes its documents
in that order and fills chunks with whole documents; a document longer than a chunk has
one of its own. A chunk's ids are cut into blocks of ``BLOCK`` ids, the last one filled
up with zeros. Every block is transposed into byte planes, or bit planes on request, and
each plane is compressed by zstandard on its own; a plane of zeros takes no bytes. Byte
planes are the default: token ids took 1.30 bytes each in them, 1.49 in bit planes.

The files are Parquet files with one row per chunk, written and committed by Spark: the
planes in one column, and beside them the chunk index (shard, chunk number, first place
in the shard, number of ids, the documents and their lengths). Being columns of their
own, the index is read without touching a plane. Any chunk can be decoded alone.

Encoding splits a text before each single space between two characters that are not
white space. Byte-level splitting never joins ids across such a place, so the distinct
pieces of a slice of documents are encoded once, and put in place by arrays. Ids of pre-tokens are remembered in the task, for up to ``REMEMBERED`` of them.

Defined cases: null and empty texts are documents of one id, the end; equal ids are told
apart by a hash of the text and then keep the order of their shard; null ids come first;
an empty table gives no chunks. Other columns are not read.
"""

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.arrow import batches_of

END_ID = 0
BLOCK = 65_536
CHUNK = 4 * BLOCK
REMEMBERED = 150_000
ROWS_AT_ONCE = 2_000
LATIN = "\u024f"  # the last letter of the Latin blocks
CHUNKS = ("shard int, chunk int, first long, n_ids long, planes_per_block int, doc_ids array<long>, "
          "doc_sizes array<long>, planes array<binary>")
SLICE_BYTES = 3_000_000
# White space as any of the libraries understands it.
_BLANK_EDGE = "^$|^[{0}]|[{0}]$".format("\\s\\x0b\\x1c-\\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
_JOINT = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=2)
def _library(vocabulary: bytes, special: bool):
    """The library's tokenizer, one for all tasks of a worker: it keeps its memory of words, several MB, when it is dropped."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary.decode())
    tokenizer.encode_special_tokens = not special  # their strings in a text are ordinary text
    return tokenizer


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers, by the tokenizers library.

    A new piece of Latin text is split by the byte-level pattern, and each pre-token is
    merged by the library's model; any other piece is encoded by the library as a whole.
    With ``special`` the strings of special tokens in a text become their ids, as in a
    plain call of the library; a text that holds an added token is encoded as a whole.
    """

    def __init__(self, vocabulary: bytes, pattern: str, special: bool = False, remembered: int = REMEMBERED) -> None:
        self.tokenizer = _library(vocabulary, special)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        self.model = self.tokenizer.model
        self.find = regex.compile(pattern).findall
        self.letters = _byte_letters()
        self.tokens: dict[str, bytes] = {}
        self.remembered = remembered

    def encode_piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        if max(piece) > LATIN:
            return self._whole(piece)
        return b"".join(self._tokens(self.find(piece)))

    def _tokens(self, tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens; those not remembered are written in byte letters all at once."""
        found = list(map(self.tokens.get, tokens))
        new = [k for k, ids in enumerate(found) if ids is None]
        if not new:
            return found
        if len(self.tokens) + len(new) > self.remembered:
            self.tokens.clear()
        words = [tokens[k] for k in new]
        data = [w.encode() for w in words]
        letters = b"".join(data).decode("latin-1").translate(self.letters)
        merged, at = self.model.tokenize, 0
        for k, word, n in zip(new, words, map(len, data)):
            found[k] = self.tokens[word] = array("I", [t.id for t in merged(letters[at : at + n])]).tobytes()
            at += n
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; the distinct pieces of all of them are encoded once."""
        parts = pc.split_pattern(pc.fill_null(texts, ""), " ")
        ends = parts.offsets.to_numpy()
        firsts, pieces = ends[:-1] - ends[0], parts.flatten()
        inner = np.ones(len(pieces), dtype=bool)
        inner[firsts] = False
        coded = pieces.filter(pa.array(inner)).dictionary_encode()
        units = coded.dictionary
        found = self._units(units)
        if found is None:
            return [self._whole(t or "") for t in texts.to_pylist()]
        ids, sizes, odd = found
        heads = texts_of(pieces.take(pa.array(firsts)))
        own = [self.encode_piece(p) for p in heads]
        # Units of all texts in order: a text's first piece, then its inner ones.
        order = np.empty(len(pieces), dtype=np.int64)
        order[inner] = coded.indices.to_numpy()
        order[firsts] = len(units) + np.arange(len(own))
        sizes = np.concatenate([sizes, np.array([len(o) // 4 for o in own], dtype=np.int64)])
        flat = gather(np.concatenate([ids, np.frombuffer(b"".join(own), dtype="<u4")]), sizes, order)
        stops = np.concatenate([[0], np.cumsum(sizes[order])])[np.append(firsts, len(pieces))]
        out = [flat[a:b].tobytes() for a, b in zip(stops, stops[1:])]
        joined = np.zeros(len(out), dtype=bool)
        joined[np.repeat(np.arange(len(out)), np.diff(ends))[inner][odd[order[inner]]]] = True
        for k in np.flatnonzero(np.diff(ends) > 1):
            joined[k] |= not heads[k] or heads[k][-1].isspace()
        added = np.zeros(len(out), dtype=bool)
        for content in self.added:
            added |= pc.match_substring(pc.fill_null(texts, ""), content).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(joined & ~added):
            out[k] = self._by_joints(texts[k].as_py())
        for k in np.flatnonzero(added):
            out[k] = self._whole(texts[k].as_py())
        return out

    def encode_spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces with a space put before each, one after another, and how many each has."""
        units = pa.array(pieces, pa.string())
        found = self._units(units) if pieces else None
        alone = range(len(pieces)) if found is None else np.flatnonzero(found[2]).tolist()
        own = [self.encode_piece(" " + pieces[k]) for k in alone]
        counts = np.array([len(o) // 4 for o in own], dtype=np.int64)
        ids = np.frombuffer(b"".join(own), dtype="<u4")
        if found is None:
            return ids, counts
        sizes = found[1].copy()
        sizes[alone] = counts
        # The pieces that were encoded together, then those encoded alone, then all in order.
        together = np.flatnonzero(~found[2])
        stored = np.concatenate([together, np.array(alone, dtype=np.int64)])
        return gather(np.concatenate([found[0], ids]), sizes[stored], np.argsort(stored)), sizes

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of pieces with a space put before each, one after another; their numbers; which have blank edges.

        None if the pieces were not split where they begin.
        """
        odd = pc.match_substring_regex(units, _BLANK_EDGE).to_numpy(zero_copy_only=False)
        wide = pc.match_substring_regex(units, f"[^\\x00-{LATIN}]").to_numpy(zero_copy_only=False) & ~odd
        plain = np.flatnonzero(~odd & ~wide)
        # No plain piece holds a blank at an edge, so in one text with spaces between they split as they do alone.
        tokens = pa.array(self.find("".join([" " + u for u in texts_of(units.take(pa.array(plain)))])), pa.string())
        begins = np.flatnonzero(pc.starts_with(tokens, " ").to_numpy(zero_copy_only=False))
        if len(begins) != len(plain):
            return None
        coded = tokens.dictionary_encode()
        known = self._tokens(texts_of(coded.dictionary))
        token_sizes = np.array([len(k) // 4 for k in known], dtype=np.int64)
        at = coded.indices.to_numpy().astype(np.int64)
        plain_ids = gather(np.frombuffer(b"".join(known), dtype="<u4"), token_sizes, at)
        sizes = np.zeros(len(units) + 1, dtype=np.int64)
        sizes[plain] = np.add.reduceat(token_sizes[at], begins) if len(begins) else 0
        # Plain pieces first, then the wide ones, then put in the order of the units.
        others = [self.encode_piece(" " + u) for u in texts_of(units.take(pa.array(np.flatnonzero(wide))))]
        sizes[np.flatnonzero(wide)] = [len(o) // 4 for o in others]
        sizes = sizes[:-1]
        stored = np.concatenate([plain, np.flatnonzero(wide), np.flatnonzero(odd)])
        place = np.argsort(stored)
        return gather(np.concatenate([plain_ids, np.frombuffer(b"".join(others), dtype="<u4")]), sizes[stored], place), sizes, odd

    def _by_joints(self, text: str) -> bytes:
        """The same for texts with other white space beside single spaces."""
        first, *rest = _JOINT.split(text)
        return b"".join(map(self.encode_piece, [first, *[" " + p for p in rest]]))


def texts_of(array: pa.Array) -> list[str]:
    """The array as a list; by way of NumPy, which makes no scalars on the way."""
    return array.to_numpy(zero_copy_only=False).tolist()


def gather(values: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Runs of ``values`` (of the given sizes, one after another) in another order."""
    n = sizes[order]
    begins = (np.cumsum(sizes) - sizes)[order]
    return values[np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def to_planes(ids: np.ndarray, kind: str, block: int, level: int = 3) -> list[bytes]:
    """Compressed planes of all blocks, lowest plane of the first block first."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    out = []
    for at in range(0, len(ids), block):
        part = np.zeros(block, dtype="<u4")
        part[: len(ids[at : at + block])] = ids[at : at + block]
        whole = part.view(np.uint8).reshape(block, 4)
        if kind == "bit":
            used = -(-int(part.max()).bit_length() // 8)
            planes = np.zeros((32, block // 8), dtype=np.uint8)
            if used:
                bits = np.unpackbits(np.ascontiguousarray(whole[:, :used]), axis=1, bitorder="little")
                planes[: 8 * used] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        else:
            planes = np.ascontiguousarray(whole.T)
        out += [squeeze(p.tobytes()) if p.any() else b"" for p in planes]
    return out


def from_planes(planes: list[bytes], per_block: int, n_ids: int, block: int) -> np.ndarray:
    """The ids again, as little-endian 32-bit numbers."""
    inflate = zstandard.ZstdDecompressor().decompress
    out = np.empty(len(planes) // per_block * block, dtype="<u4")
    width = block // 8 if per_block == 32 else block
    for k in range(len(planes) // per_block):
        own = planes[k * per_block : (k + 1) * per_block]
        used = max((i + 1 for i, p in enumerate(own) if p), default=0)
        rows = [np.frombuffer(inflate(p, max_output_size=width), dtype=np.uint8) if p else np.zeros(width, np.uint8) for p in own[: -(-used // 8) * 8 if per_block == 32 else used]]
        whole = np.zeros((block, 4), dtype=np.uint8)
        if rows and per_block == 32:
            bits = np.unpackbits(np.stack(rows), axis=1, bitorder="little")
            whole[:, : len(rows) // 8] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        elif rows:
            whole[:, : len(rows)] = np.stack(rows).T
        out[k * block : (k + 1) * block] = whole.reshape(-1).view("<u4")
    return out[:n_ids]


def _slices(batch: pa.RecordBatch, column: int):
    """Parts of a batch of about ``SLICE_BYTES`` of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_ids(docs: DataFrame, path: str, vocabulary: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
              planes: str = "byte", block: int = BLOCK, chunk: int = CHUNK, end_id: int = END_ID, level: int = 3,
              special: bool = False) -> None:
    """Encode ``docs`` and write the id files; ``vocabulary`` is a byte-level tokenizer's JSON, ``pattern`` its split.

    Strings of special tokens in a text are ordinary text, or with ``special`` their ids.
    """
    if planes not in ("bit", "byte") or block % 8:
        raise ValueError("planes are 'bit' or 'byte', and a block is a multiple of 8 ids")
    per_block = 32 if planes == "bit" else 4
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches):
        encoder, number, first = Encoder(sent.value, pattern, special), 0, 0
        shard, ids, doc_ids, sizes, held = None, [], [], [], 0

        def row():
            data = np.frombuffer(b"".join(ids), dtype="<u4")
            values = [shard, number, first, len(data), per_block, doc_ids, sizes, to_planes(data, planes, block, level)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            names = ["shard", "chunk", "first", "n_ids", "planes_per_block", "doc_ids", "doc_sizes", "planes"]
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            shard = batch.column(1)[0].as_py() if batch.num_rows else shard
            for part in _slices(batch, 2):
                for doc, data in zip(part.column(0).to_pylist(), encoder.encode(part.column(2))):
                    ids += [data, end]
                    doc_ids.append(doc)
                    sizes.append(len(data) // 4 + 1)
                    held += sizes[-1]
                    if held >= chunk:
                        yield row()
                        number, first = number + 1, first + held
                        ids, doc_ids, sizes, held = [], [], [], 0
        if doc_ids:
            yield row()

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange("id", "row").sortWithinPartitions("id", "row")
    chunks = ordered.select("id", F.spark_partition_id().alias("shard"), "text").mapInArrow(encode, CHUNKS)
    with batches_of(docs.sparkSession, ROWS_AT_ONCE):
        chunks.write.option("compression", "none").parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index with ``start``, each chunk's place among all ids."""
    index = spark.read.schema(CHUNKS).parquet(path).drop("planes")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    places = shards.select("shard", before.alias("shard_start"))  # a row per shard
    return index.join(F.broadcast(places), "shard").withColumn("start", F.col("shard_start") + F.col("first"))


def read_ids(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (little-endian 32-bit numbers) of every document."""
    starts = chunk_index(spark, path).select("shard", "chunk", F.col("start").alias("at"))
    shard_start = starts.groupBy("shard").agg(F.min("at").alias("shard_start"))
    chunks = spark.read.schema(CHUNKS).parquet(path).join(F.broadcast(shard_start), "shard")

    def decode(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                c = batch.slice(at, 1).to_pylist()[0]
                data = from_planes(c["planes"], c["planes_per_block"], c["n_ids"], block)
                ends = np.cumsum(c["doc_sizes"])
                begins = ends - np.array(c["doc_sizes"])
                yield pa.record_batch(
                    [pa.array(c["doc_ids"], pa.int64()), pa.array(begins + c["first"] + c["shard_start"], pa.int64()),
                     pa.array(c["doc_sizes"], pa.int64()), pa.array([data[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    chosen = chunks.select("first", "n_ids", "planes_per_block", "doc_ids", "doc_sizes", "planes", "shard_start")
    return chosen.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
