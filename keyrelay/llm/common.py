"""Helpers the corpus operators share: reading tables, settling results in the shared folder, Arrow columns."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from itertools import repeat
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_dir, path_exists, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the lineage ends at the written table, which
    survives lost executors, and what is used several times is computed once."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    _SETTLED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SETTLED: list[str] = []


def settled() -> list[str]:
    """The folders that settle() has written and nobody has dropped, oldest first."""
    return list(_SETTLED)


def drop_settled(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of settle() whose frames are not read any more."""
    for p in paths:
        if path_exists(spark, p):
            delete_dir(spark, p)
        _SETTLED.remove(p)


def spread_join(many: DataFrame, one: DataFrame, key: str, total: int, count: str) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has one row per key and the key's number of rows in ``many`` (column ``count``).

    Rows of a key with many of them are dealt over several tasks, and the key's row of ``one`` goes to each. ``total``: about the
    rows of ``many``; fewer than HOT_KEYS keys have over total / HOT_KEYS rows, so the list of them that is broadcast is bounded.
    """
    most = max(LEAST_HOT, total // HOT_KEYS)
    hot = F.broadcast(one.filter(F.col(count) > most).select(key, F.ceil(F.col(count) / most).cast("int").alias("_parts")))
    salt = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts"))).cast("int")
    dealt = many.join(hot, key, "left").withColumn("_salt", salt).drop("_parts")
    wanted = F.when(F.col(count) > most, F.sequence(F.lit(0), F.ceil(F.col(count) / most).cast("int") - 1)).otherwise(F.array(F.lit(0)))
    return dealt.join(one.withColumn("_salt", F.explode(wanted)).drop(count), [key, "_salt"]).drop("_salt")


#: Keys that may be dealt over several tasks (times the least number of rows that makes a key one of them, 25 million rows).
HOT_KEYS, LEAST_HOT = 100_000, 256


def slots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, unless they find it anyway: on this machine by PYTHONPATH or the working
    folder, on a cluster by --py-files."""
    sc = spark.sparkContext
    here = sc.master.startswith("local") and ROOT in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if here or "keyrelay" in sc.getConf().get("spark.submit.pyFiles", "") or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    path = os.path.join(tempfile.mkdtemp(prefix="keyrelay-py-"), "keyrelay.zip")    # Spark sends it to the executors
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(os.path.join(ROOT, "keyrelay")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(top, n), os.path.relpath(os.path.join(top, n), ROOT))
    sc.addPyFile(path)


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of an Arrow string column as UTF-8 bytes (None for null), one at a time."""
    return (x.as_py() for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()))


def columns_of(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.StructArray:
    """A struct column from row tuples."""
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c0, c1, ...: (0 repeated c0 times, 1 repeated c1 times, ...) and the place inside each run."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


class Remembered:
    """Words whose ids are known to a task: word -> row; a row's ids are one run of ``flat``.

    Bounded in words and in bytes of words and ids: when half of ``bound`` words or of HELD bytes are held, they become the older
    generation and the one before them goes; words of the older generation that come up again move to the younger one. Words of
    over LONGEST characters are encoded anew each time: their rows last until the next call.
    """

    HELD, LONGEST = 96 << 20, 64

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], bound: int, dtype: str = "<u4"):
        """``encode``: (number of ids of each word, all ids one after the other) of new words."""
        self.encode, self.bound, self.dtype, self.old = encode, bound, dtype, None
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.held = 0
        self.start = self.size = np.empty(0, np.int32)
        self.flat = np.empty(0, self.dtype)

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The ids of rows, one after the other."""
        return runs(self.flat, self.start[rows], self.size[rows])

    def forget_long(self) -> None:
        """Drop the rows behind those of remembered words."""
        n = len(self.rows)
        if len(self.start) > n:
            end = int(self.start[n])
            self.start, self.size, self.flat = self.start[:n].copy(), self.size[:n].copy(), self.flat[:end].copy()

    def _append(self, size: np.ndarray, flat: np.ndarray) -> None:
        size = size.astype(np.int32)
        self.start = np.concatenate([self.start, np.int32(len(self.flat)) + np.cumsum(size, dtype=np.int32) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, flat])

    def _add(self, words: list[str], size: np.ndarray, flat: np.ndarray) -> np.ndarray:
        rows = np.arange(len(self.rows), len(self.rows) + len(words), dtype=np.int32)
        self.rows.update(zip(words, rows.tolist()))
        self.held += sum(map(getsizeof, words)) + flat.nbytes
        self._append(size, flat)
        return rows

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Rows of distinct words, valid until the next call."""
        self.forget_long()
        if self.rows and (len(self.rows) + len(words) > self.bound // 2 or self.held > self.HELD // 2):
            self.old = (self.rows, self.start, self.size, self.flat)
            self._clear()
        found = np.fromiter(map(self.rows.get, words, repeat(-1)), np.int32, len(words))
        unknown = np.flatnonzero(found < 0)
        if len(unknown) and self.old:
            rows, start, size, flat = self.old
            before = np.fromiter((rows.get(words[k], -1) for k in unknown.tolist()), np.int32, len(unknown))
            again, before = unknown[before >= 0], before[before >= 0]
            found[again] = self._add([words[k] for k in again.tolist()], size[before],
                                     runs(flat, start[before], size[before]))
            unknown = np.flatnonzero(found < 0)
        if len(unknown):
            long = np.fromiter((len(words[k]) > self.LONGEST for k in unknown.tolist()), bool, len(unknown))
            short, unknown = unknown[~long], unknown[long]
            if len(short):
                new = [words[k] for k in short.tolist()]
                found[short] = self._add(new, *self.encode(new))
        if len(unknown):                        # behind the remembered words' rows
            found[unknown] = len(self.rows) + np.arange(len(unknown), dtype=np.int32)
            self._append(*self.encode([words[k] for k in unknown.tolist()]))
        return found


def runs(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[start:start + size] of every run, one after the other."""
    at = np.repeat(start - (np.cumsum(size, dtype=np.int32) - size), size)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at]


def strings(column: pa.Array) -> list[str]:
    """The texts of a string column without nulls."""
    return column.to_numpy(zero_copy_only=False).tolist()


def release() -> None:
    """Give memory that Arrow keeps for later back to the system; workers that wait for their next task hold less."""
    pa.default_memory_pool().release_unused()


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of a text column of about ``size`` bytes each, at least a row."""
    parts = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // size
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)
