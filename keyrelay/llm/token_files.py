"""Token-id files: bit-plane shuffling.

Ids are written in ascending document order as chunks of whole documents. A chunk's ids are cut into blocks of a fixed number
of ids; each block is transposed into planes (the k-th bit, or byte, of every id), each plane is compressed by zstandard,
and the chunk's index lists the size of every plane. The files are Parquet with one row per chunk, so that any store that
Spark writes to can hold them; ``shards`` beside them lists where each shard's ids start in the whole sequence.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import Remembered, runs, ship, slices, slots, strings, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
#: Ids of a block, ids after which a chunk ends (a document is never cut), zstandard level.
BLOCK, CHUNK, LEVEL = 1 << 16, 1 << 18, 3
#: Words remembered by a task, bytes of text that are encoded at once.
REMEMBERED, AT_ONCE = 1_000_000, 1 << 22
#: A character that is a word and a token by itself, put between the words that are encoded in one call.
MARK = "\x01"
#: Words in one call.
A_CALL = 2000
#: Latin letters, which the tokenizer only lower-cases, and ASCII marks of which it makes one token run: no apostrophe, and none
#: that a special token's name starts or ends with.
LETTERS, MARKS = r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]", r"[!-&(-;=?@\[-`{}~]"
PLAIN = re.compile(f"{LETTERS}+")
#: A word of letters with marks before and behind, for Arrow: its three parts are encoded each for itself.
FRAMED = re.sub(r"\\u(....)", r"\\x{\1}", rf"\A(?P<lead>{MARKS}*)(?P<core>{LETTERS}+)(?P<tail>{MARKS}*)\z")


def _byte_level() -> str:
    """The characters that byte-level tokenizers write the 256 bytes with: printable ones as they are, the others from
    U+0100 on. The space stays, since it separates words here."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return "".join(" " if b == 0x20 and next(others) else chr(b if b in kept else next(others)) for b in range(256))


BYTE_LEVEL = _byte_level()


# -- planes ------------------------------------------------------------------
def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block that are not all zero above the highest used one, lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if bits:
        rows = np.unpackbits(raw[:, :(top + 7) // 8], axis=1, bitorder="little", count=top or None).T if top else []
        return [np.packbits(r, bitorder="little").tobytes() for r in rows]
    return [raw[:, k].tobytes() for k in range((top + 7) // 8)]


def ids_of(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    if bits and planes:
        rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        packed = np.packbits(rows, axis=1, bitorder="little")
        raw[:, :packed.shape[1]] = packed
    else:
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, np.uint8)
    return raw.view("<u4").reshape(-1)


def pack(ids: np.ndarray, bits: bool, level: int = LEVEL) -> tuple[list[list[int]], bytes]:
    """(plane sizes per block, compressed planes one after the other) of a chunk's ids."""
    squeeze, index, out = zstandard.ZstdCompressor(level=level).compress, [], []
    for at in range(0, len(ids), BLOCK):
        planes = [squeeze(p) for p in planes_of(ids[at:at + BLOCK], bits)]
        index.append([len(p) for p in planes])
        out += planes
    return index, b"".join(out)


def unpack(index: list[list[int]], payload: bytes, n: int, bits: bool) -> np.ndarray:
    open_up, at, parts = zstandard.ZstdDecompressor().decompress, 0, []
    for k, sizes in enumerate(index):
        planes = []
        for size in sizes:
            planes.append(open_up(payload[at:at + size]))
            at += size
        parts.append(ids_of(planes, min(BLOCK, n - k * BLOCK), bits))
    return np.concatenate(parts) if parts else np.empty(0, "<u4")


# -- encoding ----------------------------------------------------------------
class Encoder:
    """Ids of texts by the tokenizers library.

    The tokenizer drops white space and no token or normalisation spans a space or line end, so the encoding of a text is
    that of its words one after the other. It cuts a word of letters off the marks around it and lower-cases it, so such a word's
    encoding is that of these parts. Words and parts already met are not encoded again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split
        self.tokenizer = Tokenizer.from_file(path)
        # the same merges without normalizer and pre-tokenizer, for words whose outcome is known beforehand
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = Split(" ", "removed")
        self.mark, = self.ids(MARK).tolist()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)        # tokens that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.known = Remembered(self.encode_words, REMEMBERED)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids one after the other); null counts as empty."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        size, flat = self.encode_distinct(words.dictionary)
        which = words.indices.to_numpy()
        start, size = (np.cumsum(size) - size).astype(np.int32)[which], size.astype(np.int32)[which]
        ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        return np.diff(ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]), runs(flat, start, size)

    def encode_distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids one after the other): marks before, letters or else the whole word, marks behind."""
        found = pc.extract_regex(words, FRAMED)
        lead, core, tail = (pc.struct_field(found, n) for n in ("lead", "core", "tail"))
        core = pc.coalesce(pc.utf8_lower(core), words)
        parts = pa.concat_arrays([pc.fill_null(lead, ""), core, pc.fill_null(tail, "")]).dictionary_encode()
        rows = self.known.rows_of(strings(parts.dictionary))[parts.indices.to_numpy()].reshape(3, -1).T
        size, flat = self.known.size[rows].sum(axis=1), self.known.gather(rows.ravel())
        self.known.forget_long()
        return size, flat

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A few calls for all words. Words of letters are cut by their last tokens, others set apart by a mark; words that hold
        the mark's character go alone."""
        plain, other, alone = [], [], []
        for k, w in enumerate(words):
            (plain if PLAIN.fullmatch(w) else alone if MARK in w else other).append(k)
        parts = [(plain, *self._letters([words[k] for k in plain])), (other, *self._joined([words[k] for k in other]))]
        for k in alone:
            ids = self.ids(words[k])
            parts.append(([k], np.array([len(ids)]), ids))
        order = np.concatenate([np.array(p[0], np.int64) for p in parts])
        size, flat = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        back = np.argsort(order)
        start = np.cumsum(size) - size
        return size[back], runs(flat, start[back].astype(np.int32), size[back].astype(np.int32))

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat = _flat_ids(self.pieces, [_as_bytes(" ".join(words[k:k + A_CALL])) for k in range(0, len(words), A_CALL)])
        return np.diff(np.flatnonzero(self.last[flat]), prepend=-1), flat

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat = _flat_ids(self.tokenizer, [f" {MARK} ".join([*words[k:k + A_CALL], ""]) for k in range(0, len(words), A_CALL)])
        marks = flat == self.mark
        return np.diff(np.flatnonzero(marks), prepend=-1) - 1, flat[~marks]


def _flat_ids(tokenizer, texts: list[str]) -> np.ndarray:
    found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return np.array(list(chain.from_iterable(found)), "<u4")


def _as_bytes(text: str) -> str:
    """What normalizer and pre-tokenizer make of words of letters: lower case, byte-level characters."""
    return codecs.charmap_decode(text.lower().encode(), "strict", BYTE_LEVEL)[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


CHUNKS = ("shard int, chunk bigint, first bigint, n_ids bigint, bits boolean, doc_ids array<bigint>, sizes array<bigint>, "
          "index array<array<int>>, payload binary")


def _chunks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, bits: bool) -> Iterator[pa.RecordBatch]:
    shard, first, number = TaskContext.get().partitionId(), 0, 0
    docs: list[int | None] = []
    parts: list[np.ndarray] = []
    size = 0

    def chunk() -> pa.RecordBatch:
        nonlocal first, number, size
        index, payload = pack(np.concatenate(parts), bits)
        row = [shard, number, first, size, bits, list(docs), [len(p) for p in parts], index, payload]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.list_(pa.list_(pa.int32())), pa.binary()]
        out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                         [c.split()[0] for c in CHUNKS.split(", ")])
        first, number, size = first + size, number + 1, 0
        docs.clear()
        parts.clear()
        return out

    for batch in batches:
        for part in (batch.slice(a, b - a) for a, b in slices(batch.column(1), AT_ONCE)):
            counts, ids = encoder(path).encode(part.column(1))
            ends = np.cumsum(counts).tolist()
            for doc_id, a, b in zip(part.column(0).to_pylist(), [0, *ends], ends):
                docs.append(doc_id)
                parts.append(np.append(ids[a:b], np.array([end_id], "<u4")))
                size += len(parts[-1])
                if size >= CHUNK:
                    yield chunk()
    if docs:
        yield chunk()


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str = VOCABULARY, end_id: int = END_ID, bits: bool = False,
                      shards: int | None = None) -> str:
    """Encode and write ``docs`` in ascending id order (nulls first; equal ids by a digest of their text).

    Null and empty texts consist of the end id alone; repeated rows are written as often as they occur; other columns are not
    read; an empty table gives files without chunks. The ids of a document are one run of the whole sequence.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(shards or slots(spark), *order).sortWithinPartitions(*order)
    rows.mapInArrow(lambda it: _chunks(it, vocabulary, end_id, bits), CHUNKS).write.parquet(f"{path}/chunks")
    sizes = spark.read.parquet(f"{path}/chunks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # one row per shard
    sizes.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{path}/shards")
    return path


DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: c[k] for n, c in zip(batch.schema.names, batch.columns)}
            ids = unpack(row["index"].as_py(), row["payload"].as_py(), row["n_ids"].as_py(), row["bits"].as_py())
            sizes = np.array(row["sizes"].as_py(), np.int64)
            ends = np.cumsum(sizes)
            start = row["start"].as_py() + row["first"].as_py() + ends - sizes
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"].as_py(), pa.int64()), pa.array(start), pa.array(sizes),
                 pa.array([ids[a:b].tobytes() for a, b in zip(ends - sizes, ends)], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the written documents; ids as little-endian unsigned 32-bit integers."""
    ship(spark)
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    starts = spark.read.schema("shard int, start bigint").parquet(f"{path}/shards")
    return (chunks.join(starts, "shard").select("start", "first", "n_ids", "bits", "doc_ids", "sizes", "index", "payload")
            .mapInArrow(_documents, DOCUMENTS))


def op4_token_files(spark, sf_dir):
    """Registered query: the whole ``documents`` table written as token files and read back."""
    path = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "llm", "token-files"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
