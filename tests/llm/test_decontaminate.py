import random

import pytest

from keyrelay.llm import decontaminate as d


def plain_words(text):
    out, now = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            now += c
        else:
            if now:
                out.append(now)
            now = ""
    return out


def plain(text, items, window=10):
    words = plain_words(text)
    hit, found = set(), set()
    for item, t in items:
        ws = plain_words(t)
        k = min(window, len(ws))
        for at in range(len(ws) - k + 1 if ws else 0):
            for i in range(len(words) - k + 1):
                if words[i:i + k] == ws[at:at + k]:
                    hit |= set(range(i, i + k))
                    found |= {str(item)} - {"None"}
    return len(words), len(hit), sorted(found)


ITEMS = [(10, "The quick brown fox jumps over the lazy dog and then runs far away home"), (9, "Été à la plage"), (3, "x"),
         (100, None), (5, " ,,, "), (None, "this one has no id but marks words all the same you see"), (9, "second text of nine"),
         (11, "The quick brown fox jumps over the lazy dog and then runs far away home"), (12, "a a a a a a a a a a a a a")]
TEXTS = ["the QUICK, brown fox jumps over the lazy dog and then... runs far away", "quick brown fox jumps over the lazy dog and",
         "été à la plage été à la plage", "x y x", None, "", "xx", "this one has no id but marks words all the same", "a " * 30,
         "second text of nine second text of nine", "éx", "x" * 5000, "the quick brown fox jumps over the lazy dog and the quick brown "
         "fox jumps over the lazy dog and then runs"]


@pytest.mark.parametrize("block", [1 << 21, 60])
def test_against_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(d, "BROADCAST", block)          # one pass, several passes
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice(["the", "quick", "brown", "a", "x", "second", "text", "of", "nine", "dog"])
                              for _ in range(60)) for _ in range(30)]
    docs = docs_of(list(enumerate(texts)) + [(0, texts[0])], extra=True)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = d.decontaminate(docs, bench).select("doc_id", "text", "found", d.n_hit().alias("n")).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r.found.n_words, r.n, r.found["items"]) == plain(r.text, ITEMS), r.text
    kept = d.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.n == 0}


def test_long_stretches(spark):
    """Occurrences across the borders of the stretches that are searched side by side."""
    rng = random.Random(9)
    words = ["w%d" % rng.randint(0, 999) for _ in range(20000)]
    items = [(str(k), " ".join(words[k:k + 12]).encode()) for k in range(0, 19000, 37)]
    (runs, found), = d.Windows(items).scan([[w.encode() for w in words]])
    assert found == {str(k) for k in range(0, 19000, 37)}
    covered = {i for k in range(0, 19000, 37) for i in range(k, k + 12)}
    assert sum(b - a for a, b in runs) == len(covered)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.decontaminate(docs_of([(1, "a b")]), none).select("found").first()[0].runs == []
    assert d.decontaminate(docs_of([]), spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []
