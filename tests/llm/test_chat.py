import random

import pytest
from pyspark.sql import functions as F

from keyrelay.llm import chat as c

HARD = ["", "\\", "\\\\", "### User:", "#### Assistant: x", "</turn>", " </turn>\n", "\\</turn>", "<\\/turn>", "a\n### System: b", "### Other 41: ",
        "x </turn>\n### Assistant: hidden </turn>\n", "$1 \\1 é𝄞", ": ", "### ", "</turn></turn>"]


def rows_of():
    rng = random.Random(5)
    out = []
    for conv in range(60):
        for turn in range(rng.randint(1, 7)):
            out.append((conv, turn, rng.choice(["user", "assistant", "system", None, "tool", "### User: ", "a: b", "</turn>"]),
                        rng.choice([None, "".join(rng.choices(HARD, k=3))])))
    return out + [(77, None, "user", "null turn"), (77, 0, "assistant", "y"), (78, 0, "user", "same"), (78, 0, "user", "same"),
                  (None, 0, "user", "no id"), (79, 0, "user", "word " * 20000), (79, 1, "assistant", "\\" * 20000)]


def test_escape_is_reversible_and_leaves_no_control(spark):
    rng = random.Random(2)
    texts = HARD + ["".join(rng.choices(["\\", "#", "### ", "User:", "</", "turn>", "/", "Other", " ", "A"], k=8)) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, u in df.select("t", c.escape(F.col("t")), c.unescape(c.escape(F.col("t")))).collect():
        assert u == t
        assert not any(x in e for x in c.TEMPLATE.controls())


def test_read_back(spark):
    rows = rows_of()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit("clash"))
    out = c.format_conversations(turns.withColumn("turns", F.lit(1)))
    out = out.withColumn("whole", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    got = {r.conv_id: r for r in out.select("conv_id", "valid", "segments", c.read_turns(F.col("whole")).alias("turns")).collect()}
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {k: [tuple(t) for t in r.turns] for k, r in got.items()} == want
    for conv, r in got.items():
        assert [s.loss for s in r.segments][1::3] == [role == "assistant" for role, _ in want[conv]]
        assert not any(s.loss for k, s in enumerate(r.segments) if k % 3 != 1)


@pytest.mark.parametrize("roles,valid", [("UA", True), ("SUA", True), ("UAUA", True), ("", False), ("U", False), ("SA", False), ("AU", False),
                                         ("UUA", False), ("UASU", False), ("SUAUA", True), ("UAX", False)])
def test_turn_order(spark, roles, valid):
    names = {"U": "user", "A": "assistant", "S": "system", "X": "tool"}
    df = spark.createDataFrame([([names[r] for r in roles],)], "roles array<string>")
    assert (df.select(c.final_state(F.col("roles"))).first()[0] in c.TEMPLATE.accepted) == valid


def test_empty_table_and_no_python(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = c.format_conversations(none)
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
