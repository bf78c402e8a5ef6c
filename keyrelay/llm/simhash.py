"""SimHash near-duplicates: pivot distance tables.

Fingerprints of equal value form one class first (a map-side aggregation), so copies never meet as pairs. Distinct
fingerprints are then brought together under the agreement of bit blocks: of ``blocks`` blocks at most ``max_bits``
can hold a differing bit, so two linked fingerprints agree on some ``blocks - max_bits`` of them. Within such a bucket the
pivot tables decide: each fingerprint's Hamming distances to ``PIVOTS`` reference fingerprints are computed once, a pair
whose distances to any one reference differ by more than ``max_bits`` is discarded (triangle inequality), and only the
survivors are compared bit by bit. Buckets above ``HOT`` members are dealt as pairs of chunks, so no task takes a whole
hot bucket. What leaves a task is a spanning forest of its links, never all pairs; components() joins the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, settle, ship, slots, spread_join, utf8
from .components import components
from .fingerprint import simhash

SHINGLE, MAX_BITS = 4, 4
#: Bit blocks; more blocks mean smaller buckets and more copies of each fingerprint. 6 suits up to about 10^9 distinct
#: fingerprints, 8 beyond that. The result is the same for any number above ``max_bits``.
BLOCKS = 6
PIVOTS = 16
#: Members of a bucket beyond which it is dealt as pairs of chunks of this size.
HOT = 8192
#: Links held in a task before they are reduced to a forest.
HELD = 1 << 20

REFERENCES = np.array([xxhash.xxh64_intdigest(b"reference", i) for i in range(PIVOTS)], "<u8")


def fingerprint_column(text: Column, size: int = SHINGLE) -> Column:
    """64-bit SimHash (as a signed long) of a text column; null and empty texts have fingerprint 0."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((simhash(t, size) for t in utf8(texts)), "<u8", len(texts))
        release()
        return pa.array(prints.view("<i8"))

    return of(text)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every reference: one row of coordinates per reference."""
    return np.stack([np.bitwise_count(prints ^ p) for p in REFERENCES]).astype(np.int8)


def close_pairs(prints: np.ndarray, pivots: np.ndarray, i: np.ndarray, j: np.ndarray,
                max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) within ``max_bits``: pivot coordinates discard, the survivors are verified."""
    for row in pivots:
        keep = np.abs(row[i] - row[j]) <= max_bits
        i, j = i[keep], j[keep]
        if not len(i):
            return i, j
    keep = np.bitwise_count(prints[i] ^ prints[j]) <= max_bits
    return i[keep], j[keep]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect the same nodes as the links (a, b): a star per component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        while not np.array_equal(step := after[after], after):
            after = step
        if np.array_equal(after, root):
            break
        root = after
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of a sorted stream of (bucket, side, fp); side 2: only pairs across sides 0 and 1.

    A bucket may spread over several batches: the rows of the last bucket are carried on to the next batch.
    """
    names = ["bucket", "cross", "side", "fp"]
    rest: list[np.ndarray] | None = None
    a, b, held = [], [], 0

    def found(cols: list[np.ndarray]) -> None:
        nonlocal held
        bucket, cross, side, fp = cols
        prints = fp.view("<u8")
        pivots = pivot_table(prints)
        i = np.arange(len(fp))
        for offset in range(1, len(fp)):
            i = i[i < len(fp) - offset]
            i = i[bucket[i] == bucket[i + offset]]
            if not len(i):
                break
            at = i[(cross[i] == 0) | (side[i] != side[i + offset])]
            x, y = close_pairs(prints, pivots, at, at + offset, max_bits)
            if len(x):
                a.append(fp[x])
                b.append(fp[y])
                held += len(x)
                if held > HELD:
                    reduce()

    def reduce() -> None:
        nonlocal held
        x, y = forest(np.concatenate(a), np.concatenate(b))
        a[:], b[:], held = [x], [y], 0

    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        if not len(cols[0]):
            continue
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols)]
        cut = int(np.searchsorted(cols[0] == cols[0][-1], True))
        rest = [c[cut:] for c in cols]
        found([c[:cut] for c in cols])
    if rest is not None:
        found(rest)
    if a:
        reduce()
        yield pa.RecordBatch.from_arrays([pa.array(a[0]), pa.array(b[0])], ["a", "b"])


def bucket_keys(fp: Column, max_bits: int, blocks: int) -> Column:
    """One key per choice of ``blocks - max_bits`` blocks: the choice's number and the bits of its blocks."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        mask = sum(masks[k] for k in chosen)
        keys.append(F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    return F.array(*keys)


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, hot: int = HOT) -> DataFrame:
    """Forest of the links between distinct fingerprints (column fp) of at most ``max_bits`` differing bits.

    Complete: whatever a 64-bit bucket digest brings together wrongly is only compared in vain.
    """
    if blocks <= max_bits:
        raise ValueError("blocks must exceed max_bits")
    spark = prints.sparkSession
    ship(spark)
    keyed = prints.select("fp", F.explode(bucket_keys(F.col("fp"), max_bits, blocks)).alias("bucket"))
    keyed = settle(keyed, "simhash-keys")
    large = (keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > hot)
             .select("bucket", F.ceil(F.col("n") / hot).cast("int").alias("chunks")))
    dealt = keyed.join(settle(large, "simhash-hot"), "bucket", "left")
    # a row of a hot bucket goes to every pair of chunks that holds its own chunk
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
    pairs = F.when(F.col("chunks").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("own", F.coalesce(own, F.lit(-1))).withColumn("other", F.explode(pairs))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    work = dealt.select(
        F.when(F.col("chunks").isNull(), F.col("bucket")).otherwise(F.xxhash64("bucket", lo, hi)).alias("bucket"),
        (F.col("own") != F.col("other")).cast("int").alias("cross"), (F.col("own") == hi).cast("int").alias("side"), "fp")
    sorted_work = work.repartition(slots(spark), "bucket").sortWithinPartitions("bucket", "side", "fp")
    return sorted_work.mapInArrow(lambda it: _links(it, max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, fp, label, component_id) for every row of ``docs``.

    fp: signed 64-bit fingerprint; label: the least fp of the component; component_id: the smallest doc_id reachable.
    Null, empty and wordless texts share fingerprint 0. Rows with a null id get a component like any other; they never
    name one (component_id is null only if the whole component has no id). Repeated rows come out repeated. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       fingerprint_column(F.col(text_col).cast("string"), size).alias("fp"))
    return group_rows(settle(rows, "simhash-rows"), max_bits, blocks)


def group_rows(rows: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Components of rows (doc_id, fp); see near_duplicates()."""
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-classes")
    roots = components(fingerprint_links(classes.select("fp"), max_bits, blocks), "simhash-links")
    labelled = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "least", "copies", F.coalesce("root", "fp").alias("label")))
    labelled = settle(labelled, "simhash-labels")
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count("fp").alias("n"))
    known = spread_join(labelled.select("fp", "label", "copies"), named, "label", labelled.count(), "n")
    return spread_join(rows, known, "fp", rows.count(), "copies").select("doc_id", "fp", "label", "component_id")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                  max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs``, all columns, one of each near-duplicate group: that of the smallest id (nulls last).

    Of rows repeated with the same id and fingerprint the first by text stays; any row of equal text is as good.
    """
    ship(docs.sparkSession)
    whole = settle(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                               F.struct("*").alias("row"))
                   .withColumn("fp", fingerprint_column(F.col("text"), size)).drop("text"), "simhash-docs")
    grouped = group_rows(whole.select("doc_id", "fp"), max_bits, blocks)
    first = grouped.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("f"))
    first = first.select(F.col("f.doc_id").alias("keep_id"), F.col("f.fp").alias("keep_fp"))
    kept = whole.join(first, (F.col("doc_id").eqNullSafe(F.col("keep_id"))) & (F.col("fp") == F.col("keep_fp")))
    order = Window.partitionBy("keep_id", "keep_fp").orderBy(F.col(f"row.{text_col}"))
    return kept.withColumn("place", F.row_number().over(order)).filter("place = 1").select("row.*")


def op1_simhash(spark, sf_dir):
    """Registered query: near-duplicate components of the whole ``documents`` table."""
    from .common import table
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
