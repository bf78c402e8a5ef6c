import public_tokenizers
import tiktoken

import corpus_pipeline
from keyrelay.llm import bpe, pii, quality
from keyrelay.llm.fingerprint import simhash as fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """The whole pipeline against a plain one-process version of each stage's decision."""
    from test_decontaminate import plain as hits
    from test_quality import plain as measured
    from test_simhash import plain_groups

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bits = {r.doc_id: r.quality.fail_bits for r in quality.measure(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    for i, t in docs:       # base rules by hand, the others by the ledger
        n, *_, repeat = measured(t)
        assert bool(bits[i] & 3) == (n < 50 or 2 * repeat > n)
    docs = [(i, t) for i, t in docs if not bits[i]]
    prints = {i: fingerprint(t.encode()) for i, t in docs}
    label, _ = plain_groups(list(prints.values()))
    first = {}
    for i, _ in docs:
        first[label[prints[i]]] = min(i, first.get(label[prints[i]], i))
    docs = [(i, t) for i, t in docs if first[label[prints[i]]] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if not hits(t, items)[1]]
    found = pii.find_spans([t for _, t in docs], pii.field())
    docs = [(i, pii.redacted(t, [dict(zip(("kind", "start", "end"), s)) for s in spans])) for (i, t), spans in zip(docs, found)]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec().ranks.ranks, special_tokens={})
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in docs}
    assert 0 < len(got) < 200


def test_stages_keep_the_columns(spark, docs_of, real):
    docs = docs_of(real, extra=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(real)


def test_registered(spark):
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert sum(n.startswith("op") for n in names) == 13


def test_scratch_of_finished_stages_is_dropped(spark):
    import corpus_pipeline
    from keyrelay.llm.common import settled
    before = settled()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    made = [p for p in settled() if p not in before]
    assert len(made) == 1 and "pipeline-bpe_encoding" in made[0] and out.count() > 0
