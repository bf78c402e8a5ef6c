import numpy as np
import pytest
import xxhash

from keyrelay.llm import simhash as s
from keyrelay.llm.components import components
from keyrelay.llm.fingerprint import simhash


def plain_print(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(prints, bits=4):
    """label of each print: least print reachable, by brute force."""
    u = sorted(set(prints))
    label = {x: x for x in u}
    changed = True
    links = [(a, b) for k, a in enumerate(u) for b in u[k + 1:] if (a ^ b).bit_count() <= bits]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label, len(links)


def test_fingerprints(real):
    small = [(i, t) for i, t in real if len(t or "") < 5000]
    assert [simhash(t.encode() if t is not None else None) for _, t in small] == [plain_print(t) for _, t in small]


def test_groups_against_brute_force(spark, docs_of, real):
    rows = {(r.doc_id, r.fp): r.component_id for r in s.near_duplicates(docs_of(real, extra=True)).collect()}
    prints = [(i, simhash(t.encode() if t is not None else None)) for i, t in real]
    label, _ = plain_groups([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    assert rows == {(i, p - (1 << 64) if p >> 63 else p): least.get(label[p]) for i, p in prints}
    assert s.near_duplicates(docs_of(real)).count() == len(real)
    assert s.near_duplicates(docs_of([])).collect() == []


@pytest.mark.parametrize("hot,blocks", [(8192, 6), (16, 5), (40, 8)])
def test_links_are_complete(spark, hot, blocks):
    """Dense balls (one hot bucket dealt in chunks) and scattered prints: same components as brute force."""
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = set(rng.integers(0, 1 << 63, 200, dtype=np.uint64).tolist()) | {0, (1 << 64) - 1}
    for c in centres.tolist():
        for _ in range(40):
            x = c
            for b in rng.integers(0, 64, rng.integers(1, 6)).tolist():
                x ^= 1 << b
            prints.add(x)
    label, n = plain_groups(prints)
    assert n > 500
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = s.fingerprint_links(df, 4, blocks, hot)
    root = {r.node: r.root for r in components(links).collect()}
    got, want = {}, {}
    for p in prints:
        got.setdefault(root.get(signed(p), signed(p)), set()).add(p)
        want.setdefault(label[p], set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert all(k == min(map(signed, v)) for k, v in got.items())


def test_pivots_keep_every_close_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    prints = np.concatenate([a, b])
    i, j = np.triu_indices(600, 1)
    x, y = s.close_pairs(prints, s.pivot_table(prints), i, j, 4)
    keep = np.bitwise_count(prints[i] ^ prints[j]) <= 4
    assert set(zip(x, y)) == set(zip(i[keep], j[keep]))


def test_forest_connects_the_same_nodes():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    x, y = s.forest(a, b)
    assert len(x) < 300
    def sets(p, q):
        part = {k: {k} for k in range(400)}
        for u, v in zip(p.tolist(), q.tolist()):
            if part[u] is not part[v]:
                part[u] |= part[v]
                for w in part[u]:
                    part[w] = part[u]
        return {frozenset(v) for v in part.values()}
    assert sets(a, b) == sets(x, y)


def test_components_of_long_paths(spark):
    n = 300
    rng = np.random.default_rng(5)
    order = rng.permutation(n).tolist()
    links = [(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001), (1001, 1000), (2000, 2000)]
    root = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert root == {**{k: 0 for k in range(n)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark, docs_of, real):
    docs = docs_of(real, extra=True)
    kept = s.keep_one_each(docs)
    assert kept.columns == docs.columns
    groups = {(r.doc_id, r.label) for r in s.near_duplicates(docs).collect()}
    want = {}
    for i, label in groups:
        want.setdefault(label, []).append(i)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == sorted(min((i is None, i or 0) for i in v) for v in want.values())
