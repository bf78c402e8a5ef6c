"""Fill-in-middle transformation by content-defined chunk memoization.

A rolling hash over the last bytes cuts texts into chunks whose borders depend on the bytes around them alone, so a passage that
several documents share is cut alike in all of them. A task remembers the boundary summary of each chunk it has met (the dictionary
compares the chunk's bytes, not a digest): code points, words that end inside, and whether the first and last characters belong to
words. Adding up the summaries of a document's chunks gives its number of units and the chunk that holds any cut; only
those chunks are looked into again.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, ship, slices, table, utf8

#: Marks of the three parts, the seed before a document's id, per cent of documents transformed, and of these as spm.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM = 42, 50, 80
#: Bytes the rolling hash covers; a chunk ends where its low bits are zero (on average after 1,024 bytes), within these sizes.
WINDOW, BITS, LEAST, MOST = 16, 10, 256, 8192
#: Bytes of text taken at once; bytes of chunks that a task remembers in two generations.
AT_ONCE, HELD = 1 << 21, 64 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
RESULT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    """A random number for each byte value."""
    return np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the numbers of the last WINDOW bytes, each shifted by its distance; doubled window by window."""
    h, width = _gear()[raw], 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def borders(raw: np.ndarray, start: list[int]) -> list[list[int]]:
    """Chunk ends of each text; text k is raw[start[k]:start[k + 1]]. No chunk ends inside a character."""
    # the hash's upper bits have seen the whole window
    ends = np.flatnonzero(rolling(raw) >> np.uint32(32 - BITS) == 0) + 1
    lead = np.append((raw & 0xC0) != 0x80, True)
    ends = ends[lead[ends]].tolist()
    out = []
    for a, b in zip(start, start[1:]):
        own, at = [], a
        while b - at > LEAST:
            k = bisect_left(ends, at + LEAST)
            nxt = ends[k] if k < len(ends) else b
            if nxt - at > MOST and b - at > MOST:
                nxt = at + MOST
                while not lead[nxt]:
                    nxt -= 1
            if nxt >= b:
                break
            own.append(nxt)
            at = nxt
        if b > a:
            own.append(b)
        out.append(own)
    return out


def word_ends(chunk: bytes) -> np.ndarray:
    """Places in a chunk where a space follows a word."""
    space = _SPACE[np.frombuffer(chunk, np.uint8)]
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


class Summaries:
    """Summary rows of chunks: (code points, words that end inside, first is of a word, last is of a word)."""

    def __init__(self, held: int = HELD):
        self.limit, self.held, self.young, self.old = held // 2, 0, {}, {}
        self.asked = self.found = 0

    def of(self, chunks: list[bytes]) -> np.ndarray:
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        known, new = self.young, {}
        for c in chunks:
            if c not in known:
                if (row := self.old.get(c)) is not None:
                    known[c] = row
                    self.held += len(c)
                else:
                    new[c] = None
        self.asked, self.found = self.asked + len(chunks), self.found + len(chunks) - len(new)
        if new:
            fresh = list(new)
            known.update(zip(fresh, summarise(fresh)))
            self.held += sum(map(len, fresh))
        return np.array([known[c] for c in chunks], np.int64).reshape(-1, 4)


def summarise(chunks: list[bytes]) -> list[tuple]:
    raw = np.frombuffer(b"".join(chunks), np.uint8)
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    first = np.cumsum(size) - size
    space = _SPACE[raw]
    ends = np.zeros(len(raw), bool)
    ends[1:] = space[1:] & ~space[:-1]
    ends[first] = False                     # whether a word ends at a chunk's border is seen when chunks are put together
    count = lambda mask: np.add.reduceat(mask.astype(np.int64), first)
    return list(zip(count((raw & 0xC0) != 0x80).tolist(), count(ends).tolist(), (~space[first]).tolist(),
                    (~space[first + size - 1]).tolist()))


class Cutter:
    """Units of one text, from the summaries of its chunks."""

    def __init__(self, chunks: list[bytes], rows: np.ndarray):
        self.chunks = chunks
        chars, inner, first, last = rows.T
        border = last.copy()                # a word ends with this chunk: the text ends here or a space comes next
        border[:-1] &= 1 - first[1:]
        self.inner, self.ends = inner, np.cumsum(inner + border)
        self.words = int(self.ends[-1]) if len(rows) else 0
        self.n = self.words + (1 if len(rows) and not last[-1] else 0)
        self.chars = np.concatenate([[0], np.cumsum(chars)])
        self.bytes = np.concatenate([[0], np.cumsum([len(c) for c in chunks], dtype=np.int64)])

    def after(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``units`` units."""
        if not units:
            return 0, 0
        if units > self.words:              # spaces at the text's end are a unit of their own
            return int(self.bytes[-1]), int(self.chars[-1])
        k = int(np.searchsorted(self.ends, units))
        nth = units - (int(self.ends[k - 1]) if k else 0)
        if nth > self.inner[k]:
            return int(self.bytes[k + 1]), int(self.chars[k + 1])
        chunk = self.chunks[k]
        at = int(word_ends(chunk)[nth - 1])
        return int(self.bytes[k]) + at, int(self.chars[k]) + len(chunk[:at].decode())


def transform(text: bytes, cutter: Cutter, h: tuple) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of a text and its four numbers."""
    n = cutter.n
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= RATE:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, a_chars), (b, b_chars) = cutter.after(low), cutter.after(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SPM:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return n, form, a_chars, b_chars - a_chars, output


@lru_cache(maxsize=1)
def _summaries() -> Summaries:
    return Summaries()


def transform_texts(texts: list[bytes], numbers: list[tuple], known: Summaries) -> list[tuple]:
    raw = np.frombuffer(b"".join(texts), np.uint8)
    start = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).tolist()
    whole = raw.tobytes()
    own = [[whole[a:b] for a, b in zip([s, *ends], ends)] for s, ends in zip(start, borders(raw, start))]
    rows = known.of([c for chunks in own for c in chunks])
    out, at = [], 0
    for text, chunks, h in zip(texts, own, numbers):
        out.append(transform(text, Cutter(chunks, rows[at:at + len(chunks)]), h))
        at += len(chunks)
    return out


def transform_column(text: Column, numbers: list[Column]) -> Column:
    """Struct of a text's transformation, from the text and four numbers."""
    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known = _summaries()
        for column, *hs in batches:
            for a, b in slices(column, AT_ONCE):            # results leave in slices, which bounds a task's memory
                texts = [t or b"" for t in utf8(column.slice(a, b - a))]
                rows = transform_texts(texts, list(zip(*(h.slice(a, b - a).to_pylist() for h in hs))), known)
                cols = list(zip(*rows))
                long = [pa.array(c, pa.int64()) for c in (cols[0], cols[2], cols[3])]
                output = pa.array(cols[4], pa.binary()).cast(pa.string())
                yield pa.StructArray.from_arrays([long[0], pa.array(cols[1], pa.string()), long[1], long[2], output],
                                                 ["n", "form", "prefix_chars", "middle_chars", "output"])
                release()

    return run(text, *numbers)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from a document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_middle(docs: DataFrame, into: str = "fim", seed: int = SEED) -> DataFrame:
    """``docs`` with a struct column: units, form, code points of prefix and middle, and the output text.

    A unit is a word with the white space before it, or the white space at a text's end. Null counts as the empty text, which
    has no units and stays plain; a null id draws as if it were empty; rows of equal id and text come out alike; an empty table
    stays empty; other columns pass through (one named as the new column is replaced). A task holds a slice of texts, the longest
    one at least, and a bounded number of remembered bytes.
    """
    ship(docs.sparkSession)
    return docs.withColumn(into, transform_column(F.col("text").cast("string"), draws(F.col("doc_id"), seed)))


def restored(output: Column, form: Column) -> Column:
    """The text before its transformation; the marks occur nowhere else in an output that is not plain."""
    parts = F.split(output, "<[PSM]>", 4)
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def op13_fill_middle(spark, sf_dir):
    """Registered query: every text of ``documents`` transformed, with digests of the output and of the restored text."""
    out = fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    f, form = F.col("fim"), F.col("fim.form")
    return out.select("doc_id", f["n"].alias("n"), form.alias("form"), f["prefix_chars"].alias("prefix_chars"),
                      f["middle_chars"].alias("middle_chars"), F.sha2(f["output"], 256).alias("output_sha256"),
                      F.sha2(restored(f["output"], form), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
  FROM documents),
h AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4
  FROM t),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi
  FROM h),
p AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle,
         array_to_string(u[hi + 1:], '') AS suffix
  FROM f)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
