"""Index fold (A2, K4-K6, J7): the aggregate form equals a row-by-row replay of the
original upsert / soft-delete / update-if-exists statements, at once and batch by batch."""

import datetime as dt
import random

from keyrelay.operators import index as idx

EV_SCHEMA = ("index_table string, c_stm string, seq long, data_state int, d_xgsj timestamp_ntz, "
             "c_baah string, n_jbfy int, apply_ts timestamp_ntz")
T0 = dt.datetime(2024, 1, 1)


def replay(events, prior=None):
    """The original statements, applied one event at a time in seq order."""
    row = dict(prior) if prior else None
    for e in sorted(events, key=lambda e: e["seq"]):
        attrs = {"d_xgsj": e["d_xgsj"], "c_baah": e["c_baah"], "n_jbfy": e["n_jbfy"]}
        if e["data_state"] == 1:
            if row is None:
                row = dict(attrs, create_time=e["apply_ts"], update_time=e["apply_ts"], data_state=1)
            else:
                row.update(attrs, update_time=e["apply_ts"], data_state=1)
        elif e["data_state"] == 0 and row is not None:
            row.update(update_time=e["apply_ts"], data_state=0)
        elif e["data_state"] == 2 and row is not None:
            row.update(attrs, update_time=e["apply_ts"], data_state=2)
    return row


def random_events(rng, n, keys, seq0=0):
    out = []
    for i in range(n):
        out.append({
            "index_table": "index_00.t_x_index", "c_stm": f"k{rng.randrange(keys)}", "seq": seq0 + i,
            "data_state": rng.choice([0, 1, 1, 2, 2, 3]),
            "d_xgsj": rng.choice([None, T0 + dt.timedelta(minutes=rng.randrange(1000))]),
            "c_baah": rng.choice([None, f"B{rng.randrange(50)}"]),
            "n_jbfy": rng.choice([None, rng.randrange(100)]),
            "apply_ts": T0 + dt.timedelta(seconds=seq0 + i),
        })
    return out


def index_events(spark, evs):
    rows = [(e["index_table"], e["c_stm"], e["seq"], e["data_state"], e["d_xgsj"], e["c_baah"], e["n_jbfy"],
             e["apply_ts"]) for e in evs]
    df = spark.createDataFrame(rows, EV_SCHEMA)
    return df.filter("data_state IN (0, 1, 2)")


def as_dict(df):
    return {r.c_stm: {k: r[k] for k in ("d_xgsj", "c_baah", "n_jbfy", "create_time", "update_time", "data_state")}
            for r in df.collect()}


def expected(evs, priors=None):
    priors = priors or {}
    out = {}
    for k in sorted({e["c_stm"] for e in evs} | set(priors)):
        r = replay([e for e in evs if e["c_stm"] == k], priors.get(k))
        if r is not None:
            out[k] = r
    return out


def test_fold_equals_replay(spark):
    rng = random.Random(7)
    evs = random_events(rng, 400, 25)
    assert as_dict(idx.fold(index_events(spark, evs))) == expected(evs)


def test_fold_in_batches_equals_fold_at_once(spark):
    rng = random.Random(11)
    evs = random_events(rng, 300, 15)
    cuts = sorted(rng.sample(range(1, 300), 4))
    prior = None
    for lo, hi in zip([0] + cuts, cuts + [300]):
        chunk = index_events(spark, evs[lo:hi])
        prior = idx.merge(prior, idx.fold_delta(chunk), broadcast_delta=(lo % 2 == 0))
        prior = spark.createDataFrame(prior.collect(), idx.INDEX_SCHEMA)   # materialise each version
    assert as_dict(prior) == expected(evs)


def test_prior_rows_in_every_state(spark):
    rng = random.Random(3)
    evs = random_events(rng, 200, 12)
    priors = {}
    for i in range(0, 16, 2):
        priors[f"k{i}"] = {"d_xgsj": None, "c_baah": f"P{i}", "n_jbfy": i, "create_time": T0,
                           "update_time": T0, "data_state": i % 3}
    prior_df = spark.createDataFrame(
        [("index_00.t_x_index", k, v["d_xgsj"], v["c_baah"], v["n_jbfy"], v["create_time"], v["update_time"],
          v["data_state"]) for k, v in priors.items()], idx.INDEX_SCHEMA)
    got = as_dict(idx.fold(index_events(spark, evs), prior_df))
    assert got == expected(evs, priors)


def test_specific_rules(spark):
    e = lambda seq, st, c=None: {"index_table": "i", "c_stm": "a", "seq": seq, "data_state": st,
                                 "d_xgsj": None, "c_baah": c, "n_jbfy": None,
                                 "apply_ts": T0 + dt.timedelta(seconds=seq)}
    # update and delete before the first insert are no-ops; NULL overwrites; delete keeps attributes
    evs = [e(1, 2, "u0"), e(2, 0), e(3, 1, "i1"), e(4, 2, None), e(5, 0)]
    got = as_dict(idx.fold(index_events(spark, evs)))["a"]
    assert got["c_baah"] is None and got["data_state"] == 0
    assert got["create_time"] == T0 + dt.timedelta(seconds=3)
    # an update revives a soft-deleted row
    evs2 = evs + [e(6, 2, "u6")]
    got2 = as_dict(idx.fold(index_events(spark, evs2)))["a"]
    assert (got2["c_baah"], got2["data_state"]) == ("u6", 2)
    # no insert at all: no row
    assert as_dict(idx.fold(index_events(spark, [e(1, 2, "x"), e(2, 0)]))) == {}
