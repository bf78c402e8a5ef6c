"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark windows become byte patterns over normalised words. Block shift tables let the search skip positions at which no
pattern can end, blocks of shift zero select a bucket of patterns by suffix, the bucket's prefixes thin it out, and direct
comparison confirms each occurrence. Many stretches of a batch of texts are searched side by side in numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import expand, settle, ship, table, utf8

WINDOW = 10
#: Bytes of a block (at most a machine word), bits of the shift table's hash, bytes of a stretch of text.
BLOCK, HASH_BITS, STRETCH = 8, 18, 1024
#: Patterns of fewer bytes are searched apart, since the shortest pattern bounds every shift.
SHORT = 24
#: Bytes of text searched at once in a task; bytes of benchmark text whose tables are broadcast at once.
AT_ONCE, BROADCAST = 8 << 20, 2 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, runs of digits, ASCII letters and non-ASCII characters."""
    return text.translate(_WORD).split() if text else []


def _load(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``size`` bytes from each place as one integer; ``data`` has 8 bytes of padding."""
    whole = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    return whole[at] & np.uint64((1 << 8 * size) - 1)


class _Tables:
    """Shift table, suffix buckets and prefixes of patterns of at least ``m`` bytes."""

    def __init__(self, patterns: list[bytes]):
        self.m = m = min(map(len, patterns))
        self.size = size = min(BLOCK, m)
        heads = np.frombuffer(b"".join(p[:m] + bytes(8) for p in patterns), np.uint8)
        first = np.arange(len(patterns)) * (m + 8)
        self.shift = np.full(1 << HASH_BITS, min(255, m - size + 1), np.uint8)
        for end in range(size, m + 1):
            np.minimum.at(self.shift, self._hash(_load(heads, first + end - size, size)), min(255, m - end))
        suffix = _load(heads, first + m - size, size)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.prefix = suffix[order], _load(heads, first, size)[order]
        self.patterns = [patterns[k] for k in order]
        self.order = order

    @staticmethod
    def _hash(blocks: np.ndarray) -> np.ndarray:
        return (blocks * _MIX) >> np.uint64(64 - HASH_BITS)

    def search(self, text: bytes, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position, pattern number) of every occurrence; ``data`` is ``text`` padded by 8 bytes."""
        last = len(text) - self.m + 1
        if last <= 0:
            return
        at = np.arange(0, last, STRETCH)
        stop = np.minimum(at + STRETCH, last)
        found = []
        while len(at):
            step = self.shift[self._hash(_load(data, at + (self.m - self.size), self.size))]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(step, 1)
            if not (on := at < stop).all():
                at, stop = at[on], stop[on]
        if not found:
            return
        at = np.concatenate(found)
        block = _load(data, at + (self.m - self.size), self.size)
        lo, hi = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        owner, place = expand(hi - lo)
        pattern = lo[owner] + place
        same = self.prefix[pattern] == _load(data, at[owner], self.size)
        for p, k in zip(at[owner][same].tolist(), pattern[same].tolist()):
            if text.startswith(self.patterns[k], p):
                yield p, int(self.order[k])


class Windows:
    """All windows of some benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for k in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(b" %b " % b" ".join(words[k:k + window]), set()).update([item] * (item is not None))
        self.groups = []
        for own in ([p for p in owners if len(p) >= SHORT], [p for p in owners if len(p) < SHORT]):
            if own:
                self.groups.append((_Tables(own), [p.count(b" ") - 1 for p in own], [owners[p] for p in own]))

    def scan(self, texts: list[list[bytes]]) -> list[tuple[list[list[int]], set[str]]]:
        """Per text (as words): the runs of hit words [first, end), and the items found."""
        out: list = [([], set()) for _ in texts]
        text = b"\0".join(b" %b " % b" ".join(w) if w else b"" for w in texts)
        data = np.frombuffer(text + bytes(8), np.uint8)
        hits = [(p, n[k], items[k]) for tables, n, items in self.groups for p, k in tables.search(text, data)]
        if not hits:
            return out
        at = np.array([h[0] for h in hits])
        starts = np.concatenate([[0], np.flatnonzero(data[:len(text)] == 0) + 1])
        spaces = np.flatnonzero(data[:len(text)] == 32)
        doc = np.searchsorted(starts, at, "right") - 1
        word = np.searchsorted(spaces, at) - np.searchsorted(spaces, starts[doc])
        for k in np.lexsort((word, doc)).tolist():
            runs, items = out[doc[k]]
            first, end = int(word[k]), int(word[k]) + hits[k][1]
            if runs and first <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([first, end])
            items |= hits[k][2]
        return out


FOUND = "struct<n_words: bigint, runs: array<array<bigint>>, items: array<string>>"
_TYPE = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def _slices(texts: Iterable[bytes | None]) -> Iterator[list[bytes | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or b"")
        if size >= AT_ONCE:
            yield part
            part, size = [], 0
    yield part


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's items in blocks of bounded size, one block on the driver at a time."""
    part, size = [], 0
    row: Row
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        if row[1]:
            part.append((row[0], row[1].encode()))
            size += len(part[-1][1])
        if size >= BROADCAST:
            yield part
            part, size = [], 0
    yield part


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  window: int = WINDOW, found: str = "found") -> DataFrame:
    """``docs`` with a struct column ``found``: n_words, runs of hit words [first, end) and the items found.

    A document word inside any occurrence of a window of ``window`` benchmark words is hit; an item of fewer words (not
    none) is one window. Null or empty texts have no words and no hits, null or wordless items no windows; an item
    without id marks words but cannot be named; repeated rows are judged alike; an empty benchmark hits nothing. The benchmark is
    searched in blocks whose tables have a bounded size, one pass over ``docs`` per block. If there are several, the rows are written
    once with a number of their own; each block then writes the hits of the rows that have any, its tables are
    released, and the hits are put together by row at the end.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = _blocks(benchmark, id_col, text_col)
    block = next(blocks)
    rows, parts, text = docs, [], F.col(text_col).cast("string")
    while True:
        following = next(blocks, [])
        tables = spark.sparkContext.broadcast(Windows(block, window))
        scanned = _scan_column(text, tables)
        if not following and not parts:
            return docs.withColumn(found, scanned)
        if not parts:
            packed = docs.select(F.struct("*").alias("row"), text.alias("text"))
            rows = settle(packed.withColumn("number", F.monotonically_increasing_id()), "decontaminate-rows")
        hits = rows.select("number", _scan_column(F.col("text"), tables).alias("hit"))
        # the first block's pass keeps the words of every row, the others only rows with hits
        parts.append(settle(hits if not parts else hits.filter(F.size("hit.runs") > 0), "decontaminate-hits"))
        tables.destroy()
        if not following:
            break
        block = following
    each = reduce(DataFrame.unionByName, parts)
    # one entry per block and row at most
    merged = each.groupBy("number").agg(F.max("hit.n_words").alias("n_words"), F.flatten(F.collect_list("hit.runs")).alias("runs"),
                                        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit.items")))).alias("items"))
    union = F.aggregate(F.array_sort("runs"), F.array().cast("array<array<bigint>>"), _joined_runs)
    merged = merged.select("number", F.struct("n_words", union.alias("runs"), "items").alias("hit"))
    out = rows.join(merged, "number").select("row.*", F.col("hit").alias("_hit"))
    return out.withColumn(found, F.col("_hit")).drop("_hit")


def _joined_runs(done: Column, run: Column) -> Column:
    """Runs in order of their start, with those that touch joined."""
    last = F.try_element_at(done, F.lit(-1))
    touch = F.coalesce(run[0] <= last[1], F.lit(False))
    longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.array(last[0], F.greatest(last[1], run[1]))))
    return F.when(touch, longer).otherwise(F.concat(done, F.array(run)))


def _scan_column(text: Column, tables) -> Column:
    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        rows = []
        for part in _slices(utf8(texts)):
            words = [words_of(t) for t in part]
            rows += [{"n_words": len(w), "runs": runs, "items": sorted(items)}
                     for w, (runs, items) in zip(words, tables.value.scan(words))]
        return pa.array(rows, _TYPE)

    return scan(text)


def n_hit(found: str = "found"):
    """Number of hit words in a ``found`` column."""
    return F.aggregate(F.col(f"{found}.runs"), F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    return decontaminate(rows, benchmark, **options).filter(F.size("found.runs") == 0).select("row.*")


def op6_decontaminate(spark, sf_dir):
    """Registered query: benchmark windows in the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("found.n_words").alias("n_words"), n_hit().alias("n_hit"),
                      F.size("found.items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                      (n_hit() > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws,
             row_number() OVER () AS r FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + 9], ' ') AS g
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
       FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, ks WHERE len(ws) >= k)),
m AS (SELECT dw.r, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
h AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
