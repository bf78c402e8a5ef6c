"""Language identification: held-out accuracy, the network against plain loops, and what it may learn from."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyrelay.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents)


def test_held_out_accuracy(spark, documents):
    found = {r.doc_id: r for r in language.op11_language(spark, SF).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 < found[r.doc_id].score <= 1
    out = [r for r in rows if found[r.doc_id].held_out and r.lang is not None]
    right = [found[r.doc_id].lang_pred == r.lang for r in out]
    assert len(out) > 250 and sum(right) / len(right) > 0.985
    for lang in {r.lang for r in out}:
        own = [found[r.doc_id].lang_pred == lang for r in out if r.lang == lang]
        assert sum(own) / len(own) > 0.95


def plain(model, text):
    """Mean probabilities of a text's windows, filter by filter and place by place."""
    net, total = model.net, np.zeros(len(model.labels))
    for a in range(0, len(text), net.window):
        hidden = []
        for k, w in enumerate(net.widths):
            for f in range(k * net.filters, (k + 1) * net.filters):
                best = -np.inf
                for p in range(net.window):
                    seen = [text[a + p + j] if a + p + j < len(text) else 0 for j in range(w)]
                    best = max(best, sum(float(model.places[j][b, f]) for j, b in enumerate(seen)))
                hidden.append(max(best + float(model.bias[f]), 0.0))
        x = np.array(hidden) @ model.out.astype(float) + model.out_bias
        e = np.exp(x - x.max())
        total += e / e.sum() * min(net.window, len(text) - a)
    return total / len(text)


def test_predictions_against_plain_loops(documents):
    net = language.Network(window=32, filters=4, per_language=20, epochs=1)
    model = language.fit(documents, net)
    texts = [b"", b"a", b"the " * 20, "über die Straße gehen".encode() * 7, b"x" * 32, b"x" * 33]
    label, score = language.predict(model, texts)
    assert label[0] == -1 and score[0] == 0
    for k, t in enumerate(texts[1:], 1):
        want = plain(model, t)
        assert want[label[k]] == pytest.approx(want.max(), abs=1e-5) and score[k] == pytest.approx(want.max(), abs=1e-5)
        assert language.predict(model, [t])[1][0] == pytest.approx(score[k], abs=1e-5)


def test_gradients():
    """One step of training moves the weights against the numerically computed slope."""
    net = language.Network(window=16, widths=(2, 3), filters=3, epochs=1, batch=64, rate=1e-4)
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 123, (64, 18)).astype(np.uint8), rng.integers(0, 3, 64)

    def loss(m):
        return -np.log(m.probabilities(x)[np.arange(64), y]).mean()

    before, after = language.Model(["a", "b", "c"], net), language.Model(["a", "b", "c"], net)
    after.train(x, y)
    assert loss(after) < loss(before)
    checked = 0
    for name, at in [("bias", (0,)), ("bias", (5,)), ("out", (2, 1)), ("out_bias", (2,)), *(("places", (j, b, f))
                     for j in (0, 1, 2) for b in (100, 110, 120) for f in (1, 4) if j < 2 or f > 2)]:
        probe = language.Model(["a", "b", "c"], net)
        w = probe.places[at[0]] if name == "places" else getattr(probe, name)
        moved = after.places[at[0]] if name == "places" else getattr(after, name)
        at = at[1:] if name == "places" else at
        start, step = w[at], 1e-2
        w[at] = start + step
        up = loss(probe)
        w[at] = start - step
        slope = (up - loss(probe)) / (2 * step)
        if abs(slope) > 2e-3:
            checked += 1
            assert np.sign(moved[at] - start) == -np.sign(slope)
    assert checked > 3
    # the place beyond the narrow filters' width takes no part
    assert (after.places[2][:, :3] == 0).all()


def test_learns_from_allowed_rows_alone(documents, model):
    changed = documents.withColumn("text", F.when(language.held_out(F.col("doc_id")), F.lit("zzz qqq")).otherwise(F.col("text")))
    changed = changed.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    other = language.fit(changed.withColumn("source", F.lit("s")).repartition(5))
    assert other.labels == model.labels
    assert all(np.array_equal(a, b) for a, b in zip([*other.places, other.out], [*model.places, model.out]))


def test_one_text_in_a_third_of_all_rows(spark, documents, model):
    """Copies of one text neither fill the sample nor stop the fit."""
    copies = spark.range(500).select((F.col("id") + 10**6).alias("doc_id"), F.lit("the same words again").alias("text"),
                                     F.lit("en").alias("lang"))
    both = documents.select("doc_id", "text", "lang").unionByName(copies)
    found = language.sample(both, language.Network(per_language=100))
    assert len({lang for lang, _ in found}) == 4
    out = language.identify(copies, language.fit(both)).select("language.*").distinct().collect()
    assert len(out) == 1


def test_odd_texts_and_tables(docs_of, model):
    rows = [(1, None), (2, ""), (3, " 12 . "), (4, "the house"), (4, "the house"), (None, "und der"), (5, "the of and " * 30000),
            (6, "\x00"), (7, "中文")]
    out = language.identify(docs_of(rows, extra=True), model).select("doc_id", "text", "language.*").collect()
    assert len(out) == len(rows)
    for r in out:
        lettered = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred in model.labels and 0 < r.score <= 1) if lettered else (r.lang_pred, r.score) == ("und", 0.0)
    assert len({(r.lang_pred, r.score) for r in out if r.doc_id == 4}) == 1
    assert language.identify(docs_of([]), model).collect() == []
    assert language.fit(docs_of([])) is None
    none = language.identify(docs_of([(1, "abc")]), None).select("language.*").collect()
    assert [tuple(r) for r in none] == [("und", 0.0)]
