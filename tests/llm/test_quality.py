from collections import Counter

from pyspark.sql import functions as F

from keyrelay.llm import quality as q


def plain(text):
    text = text or ""
    gaps = "\x20\t\n\x0b\x0c\r"
    words, now = [], ""
    for c in text + " ":
        if c in gaps:
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    repeat = len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)})
    lines = [x for x in text.split("\n") if x.strip(gaps)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat)


def test_measurements_against_brute_force(docs_of, real):
    rows = real + [(5, "a b c a b c a b"), (6, "a a a a"), (7, "x y z. x y z"), (8, "l\nl\n\n \nl\nm"), (9, "#*$%&|<> # $")]
    out = q.measure(docs_of(rows, extra=True)).select("doc_id", "text", "quality.*").collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(r.text), r.doc_id
        assert bool(r.fail_bits & q.mask("v1-base")) == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
    assert q.measure(docs_of([])).collect() == []


def test_policies_and_ablations(docs_of, real):
    ledger = q.measure(docs_of(real))
    bits = [r[0] for r in ledger.select("quality.fail_bits").collect()]
    got = {r.rule: (r.n_failed, r.n_regained) for r in q.ablations(ledger, "v2").collect()}
    full = q.mask("v2")
    for rule in q.POLICIES["v2"]:
        b = q.bit(rule)
        assert got[rule] == (sum(bool(x & b) for x in bits), sum(x & full == b for x in bits))
    assert ledger.filter(q.passes("v1-base")).count() == sum(x & q.mask("v1-base") == 0 for x in bits)


def test_passing_documents_keep_columns(docs_of, real):
    docs = docs_of(real, extra=True)
    kept = q.passing_documents(docs)
    assert kept.columns == docs.columns
    want = q.measure(docs).filter(F.col("quality.fail_bits") == 0).count()
    assert kept.count() == want > 0


def test_labelled_documents(spark):
    """Documents labelled as of good quality pass unless a base rule rejects them, bad ones fail."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "good")
    rows = q.measure(docs).join(labels, "doc_id").select("quality.fail_bits", "good").collect()
    base = q.mask("v1-base")
    assert all(not r.fail_bits for r in rows if r.good and not r.fail_bits & base)
    assert all(r.fail_bits for r in rows if not r.good)


def test_runs_without_python(docs_of):
    plan = q.measure(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
