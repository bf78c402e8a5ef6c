"""Byte-level BPE by monoid tree reduction.

A piece of text is encoded in halves, recursively; neighbours are joined by encoding a window of tokens around the boundary
anew, and the window grows until the tokens beside it provably stay. The proof is local: a token sequence is the BPE encoding
of its bytes exactly if every two adjacent tokens are the encoding of their joint bytes, so a join is right as soon as the
pairs on both edges of the window (all other pairs are unchanged) pass this test. Every piece of over LEAF bytes that is no token
goes through the tree. The trees of many pieces are reduced side by side: leaves of LEAF bytes, then one level of joins of all pieces
after the other; equal leaves, pairs and windows of a level are looked up once. Decoding concatenates neighbours up a tree too.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Remembered, expand, release, runs, ship, slices, strings, table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes up to which a part is a leaf of the tree and merged directly, and up to which parts and windows are remembered; tokens on
#: each side of a boundary that are encoded anew first; bytes from which a window is merged with a queue.
LEAF, SHARED, EDGE, LONG = 3, 12, 1, 48
#: Words remembered by a task, parts, windows and token pairs (each), bytes of text encoded at once.
REMEMBERED, PARTS, AT_ONCE = 300_000, 400_000, 1 << 22
#: Neighbours concatenated at once in decoding.
FAN = 64
NONE = 1 << 62
#: A space beside another white-space character.
BESIDE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}] | [\s\x0B\x1C-\x1F\x{85}\p{Z}]"
#: A space, a character that is not white space, and no other space.
PLAIN = r"\A [^\s\x0B\x1C-\x1F\x{85}\p{Z}][^ ]*\z"


class Ranks:
    """A rank file: encodes and decodes pieces."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.length = np.zeros(max(self.token) + 1, np.int64)
        self.length[list(self.token)] = list(map(len, self.token.values()))
        self.bytes_of = np.full(len(self.length), None, object)
        self.bytes_of[list(self.token)] = list(self.token.values())
        self.stable: dict[int, bool] = {}
        self.parts: dict[bytes, list[int]] = {}
        self.windows: dict[bytes, list[int]] = {}

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        return self.tree(piece) if whole is None else [whole]

    def tree(self, piece: bytes) -> list[int]:
        """Halves are encoded for themselves and joined; a leaf is a few bytes. Short parts are shared by many pieces: their
        encodings are remembered."""
        if len(piece) > SHARED:
            half = len(piece) // 2
            return self.join(self.tree(piece[:half]), self.tree(piece[half:]))
        known = self.parts.get(piece)
        if known is None:
            if len(self.parts) >= PARTS:
                self.parts.clear()
            half = len(piece) // 2
            known = self.parts[piece] = (self.merge(piece) if len(piece) <= LEAF
                                         else self.join(self.tree(piece[:half]), self.tree(piece[half:])))
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings."""
        if self.fits(left[-1], right[0]):
            return left + right
        edge = EDGE
        while True:
            a, b = max(0, len(left) - edge), min(len(right), edge)
            window = self.window(self.flat(left[a:]) + self.flat(right[:b]))
            if (a == 0 or self.fits(left[a - 1], window[0])) and (b == len(right) or self.fits(window[-1], right[b])):
                return left[:a] + window + right[b:]
            edge *= 2

    def window(self, piece: bytes) -> list[int]:
        """merge() of the bytes around a boundary; short windows come up again and again."""
        if len(piece) > SHARED:
            return self.merge(piece)
        known = self.windows.get(piece)
        if known is None:
            if len(self.windows) >= PARTS:
                self.windows.clear()
            known = self.windows[piece] = self.merge(piece)
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether the tokens a, b are the encoding of their joint bytes."""
        pair = a << 32 | b
        known = self.stable.get(pair)
        if known is None:
            if len(self.stable) >= PARTS:
                self.stable.clear()
            known = self.stable[pair] = self.window(self.token[a] + self.token[b]) == [a, b]
        return known

    def merge(self, piece: bytes) -> list[int]:
        """Merge adjacent tokens of the lowest rank, leftmost first, until none can be merged."""
        if len(piece) > LONG:
            return self.merge_long(piece)
        rank, cut = self.ranks.get, list(range(len(piece) + 1))
        pairs = [rank(piece[i:i + 2], NONE) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) != NONE:
            i = pairs.index(least)
            del pairs[i], cut[i + 1]
            if i < len(pairs):
                pairs[i] = rank(piece[cut[i]:cut[i + 2]], NONE)
            if i:
                pairs[i - 1] = rank(piece[cut[i - 1]:cut[i + 1]], NONE)
        return [self.ranks[piece[a:b]] for a, b in zip(cut, cut[1:])]

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """encode() of many pieces: (number of ids of each, all ids one after the other)."""
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int32, len(pieces))
        other, size = np.flatnonzero(whole < 0), np.ones(len(pieces), np.int64)
        size[other], flat = self.trees([pieces[k] for k in other.tolist()])
        ids = np.repeat(whole, size)
        ids[ids < 0] = flat
        return size, ids

    def trees(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """tree() of many pieces: their leaves, and then neighbours joined level by level until each piece is one run of ids."""
        data, length = np.frombuffer(b"".join(pieces), np.uint8), np.fromiter(map(len, pieces), np.int64, len(pieces))
        piece, number = expand(-(-length // LEAF))
        start, size, ids = self.encodings(data, (np.cumsum(length) - length)[piece] + LEAF * number,
                                          np.minimum(LEAF, length[piece] - LEAF * number))
        flat, first = runs(ids, start, size), np.cumsum(size) - size
        while len(left := np.flatnonzero((piece[1:] == piece[:-1]) & (number[:-1] % 2 == 0))):
            flat, first = self.joins(data, flat, first, left)
            stay = np.ones(len(piece), bool)
            stay[left + 1] = False
            piece, number, first = piece[stay], number[stay] // 2, first[stay]
        return np.diff(np.append(first, len(flat))), flat

    def joins(self, data: np.ndarray, flat: np.ndarray, first: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """join() of the runs ``left`` of ids, which start at ``first``, with the runs behind them: (all ids, where runs start)."""
        low, middle, high = first[left], first[left + 1], np.append(first, len(flat))[left + 2]
        open_ = ~self.fit(flat[middle - 1], flat[middle])
        low, middle, high = low[open_], middle[open_], high[open_]
        at, edge, done = np.concatenate([[0], np.cumsum(self.length[flat])]), EDGE, []
        while len(middle):
            a, b = np.maximum(low, middle - edge), np.minimum(high, middle + edge)
            start, size, ids = self.encodings(data, at[a], at[b] - at[a])
            right = np.ones(len(middle), bool)
            k = np.flatnonzero(a > low)
            right[k] = self.fit(flat[a[k] - 1], ids[start[k]])
            k = np.flatnonzero(right & (b < high))
            right[k] = self.fit(ids[start[k] + size[k] - 1], flat[b[k]])
            done.append((a[right], b[right], size[right], runs(ids, start[right], size[right])))
            low, middle, high = low[~right], middle[~right], high[~right]
            edge *= 2
        if not done:
            return flat, first
        a, b, size, new = map(np.concatenate, zip(*done))       # flat[a:b] becomes the next ``size`` of ``new``
        shift, gone = np.zeros((2, len(flat) + 1), np.int64)
        shift[b] = size - (b - a)
        gone[a] += 1
        gone[b] -= 1
        shift, kept = np.cumsum(shift), np.flatnonzero(np.cumsum(gone[:-1]) == 0)
        out = np.empty(len(flat) + int(shift[-1]), flat.dtype)
        out[kept + shift[kept]] = flat[kept]
        out[np.repeat(a + shift[a] - (np.cumsum(size) - size), size) + np.arange(len(new))] = new
        return out, first + shift[first]

    def encodings(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """window() of slices of ``data``, equal ones once: (where each one's ids start, their number, ids)."""
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(runs(data, start, size))]
        coded = pa.Array.from_buffers(pa.binary(), len(size), buffers).dictionary_encode()
        found = list(map(self.window, coded.dictionary.to_pylist()))
        n = np.fromiter(map(len, found), np.int64, len(found))
        which = coded.indices.to_numpy()
        return (np.cumsum(n) - n)[which], n[which], np.fromiter(chain.from_iterable(found), np.int32, int(n.sum()))

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """fits() of many pairs, equal ones once."""
        coded = pa.array(a.astype(np.int64) << 32 | b).dictionary_encode()
        pairs = coded.dictionary.to_pylist()
        known = [self.fits(p >> 32, p & 0xFFFFFFFF) if k is None else k for p, k in zip(pairs, map(self.stable.get, pairs))]
        return np.array(known, bool)[coded.indices.to_numpy()]

    def merge_long(self, piece: bytes) -> list[int]:
        """merge() with a queue, for windows that have grown long."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))             # a token starts at i and ends at end[i]
        before = list(range(-1, n - 1))
        alive = bytearray(b"\1") * n
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            if not alive[i] or end[i] == n or end[end[i]] != stop:
                continue                        # one of the two tokens has been merged meanwhile
            gone = end[i]
            alive[gone], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(queue, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(queue, (r, k, stop))
        return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def flat(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """Bytes of ids, concatenated up a tree: neighbours are joined FAN at a time, level by level."""
        parts = self.bytes_of[np.asarray(ids, np.int64)].tolist()
        while len(parts) > 1:
            parts = [b"".join(parts[k:k + FAN]) for k in range(0, len(parts), FAN)]
        return parts[0] if parts else b""


class Codec:
    """Encodes texts: cut into words at single spaces, words into pieces by the pattern, pieces into ids.

    A space between two characters that are not white space always starts a piece, so the words that start with such spaces
    are encoded each for itself, and remembered. Texts with a space beside other white space are cut by the pattern alone; only
    their pieces are remembered.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = Ranks(path), regex.compile(pattern)
        self.known = Remembered(self.encode_words, REMEMBERED, "<i4")
        self.pieces = Remembered(self.encode_pieces, REMEMBERED // 3, "<i4")

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.ranks.encode_many([p.encode() for p in pieces])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words that start with their only space are cut together: a space starts a word there, and nothing else does."""
        plain = pc.match_substring_regex(pa.array(words, pa.string()), PLAIN).to_numpy(zero_copy_only=False)
        other = [self.pattern.findall(words[k]) for k in np.flatnonzero(~plain).tolist()]
        pieces = self.pattern.findall("".join(compress(words, plain.tolist())))
        n = len(pieces)
        pieces = pa.array(chain(pieces, chain.from_iterable(other)), pa.string())
        first = np.flatnonzero(pc.starts_with(pieces[:n], " ").to_numpy(zero_copy_only=False))
        counts = np.concatenate([np.diff(np.append(first, n)), np.fromiter(map(len, other), np.int64, len(other))])
        coded = pieces.dictionary_encode()
        rows = self.pieces.rows_of(strings(coded.dictionary))[coded.indices.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(self.pieces.size[rows], dtype=np.int64)])
        size, flat = np.diff(ends[np.concatenate([[0], np.cumsum(counts)])]), self.pieces.gather(rows)
        self.pieces.forget_long()
        back = np.argsort(np.argsort(~plain, kind="stable"))
        return size[back], runs(flat, (np.cumsum(size) - size)[back], size[back])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids one after the other); null counts as empty."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, BESIDE).to_numpy(zero_copy_only=False)
        easy = pc.if_else(pa.array(whole), "", texts)
        lists = pc.split_pattern(easy, " ")
        words = lists.flatten().dictionary_encode()
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        distinct = strings(words.dictionary)
        first = [distinct[k] for k in words.indices.to_numpy()[at[:-1]].tolist()]
        # a text's first word has no space before it, so it differs from all other names
        more, where = _distinct(first)
        rows = self.known.rows_of([*(" " + w for w in distinct), *more])
        of = rows[:len(distinct)][words.indices.to_numpy()]
        of[at[:-1]] = rows[len(distinct):][where]
        start, size, flat = self.known.start[of], self.known.size[of], self.known.flat
        self.known.forget_long()
        if whole.any():                         # one empty word stands for each of these texts
            own, ids = self.encode_words(strings(texts.filter(pa.array(whole))))
            place = at[:-1][whole]
            start[place], size[place] = len(flat) + np.cumsum(own) - own, own
            flat = np.concatenate([flat, ids])
        ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        return np.diff(ends[at]), runs(flat, start, size)


def _distinct(names: list[str]) -> tuple[list[str], np.ndarray]:
    place: dict[str, int] = {}
    where = np.fromiter((place.setdefault(n, len(place)) for n in names), np.int64, len(names))
    return list(place), where


@lru_cache(maxsize=2)
def codec(path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> Codec:
    return Codec(path, pattern)


def encode_text(text: str, path: str = VOCABULARY) -> list[int]:
    return codec(path).encode(pa.array([text]))[1].tolist()


CODED = "struct<ids: array<int>, decoded: binary>"


def code_column(text: Column, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Struct of the ids of a text column, without special tokens, and of the bytes these ids decode to."""
    @F.arrow_udf(CODED)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for texts in batches:
            for a, b in slices(texts, AT_ONCE):         # results leave in slices, which bounds a task's memory
                n, flat = own.encode(texts.slice(a, b - a))
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                decoded = [own.ranks.decode(flat[i:j]) for i, j in zip(ends.tolist(), ends[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.StructArray.from_arrays([lists, pa.array(decoded, pa.binary())], ["ids", "decoded"])
                release()

    return code(text)


def decode_column(ids: Column, path: str = VOCABULARY) -> Column:
    """Bytes (binary) of a column of ids; null gives no bytes."""
    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        decoder = codec(path).ranks.decode
        return pa.array((decoder(x.values.to_numpy()) if x.is_valid else b"" for x in lists), pa.binary())

    return decode(ids)


def encode_documents(docs: DataFrame, text_col: str = "text", path: str = VOCABULARY, into: str = "coded") -> DataFrame:
    """``docs`` with a struct column: the ids of its texts and the bytes these ids decode to.

    Null and empty texts have no ids; repeated rows are encoded alike; an empty table stays empty; other columns pass
    through (one named as the new column is replaced).
    """
    ship(docs.sparkSession)
    return docs.withColumn(into, code_column(F.col(text_col).cast("string"), path))


def digests(docs: DataFrame, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of documents, with the ids themselves if asked for."""
    out = encode_documents(docs.select("doc_id", "text"))
    ids = F.col("coded.ids")
    found = out.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2(F.col("coded.decoded"), 256).alias("decoded_sha256"), ids.alias("ids"))
    return found if keep_ids else found.drop("ids")


def op7_bpe(spark, sf_dir):
    """Registered query: every text of ``documents`` encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"))
