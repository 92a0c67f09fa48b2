"""The set-based classification against a row-by-row statement of its rules, in any order of rows, at once or batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import history

SCHEMA = "batch int, file string, row int, rec string, ts int, a string, b string, txt string"
ARGS = dict(record=["rec"], ts="ts", batch="batch", lineage=["file", "row"], values=["a", "b", "txt"], loose=["txt"])


def rows_of(seed, n=400):
    r = random.Random(seed)
    pick = lambda *x: r.choice(x)
    return [(r.randrange(4), pick("f1", "f2"), i, pick("p", "q", "r", "s", "t", None) if i % 11 else None, pick(*range(8), None) if i % 13 else None, pick("x", "y"), pick("u", "u", None), pick("1", "01")) for i in range(n)]


def by_hand(rows):
    held, out = {}, {}
    for batch in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == batch), key=lambda r: (r[1], r[2]))
        current = {rec: max(v) for rec, v in held.items()}
        before = {rec: set(v) for rec, v in held.items()}
        added = {}
        for r in mine:
            _, file, n, rec, ts, *values = r
            if rec is None or ts is None:
                out[n] = ("QUARANTINED", "SOURCE_RECORD_ID_MISSING" if rec is None else "TIMESTAMP_MISSING")
                continue
            versions = held.setdefault(rec, {})
            first = versions.get(ts)
            conflict = first is not None and any(x is not None and y is not None and x != y for x, y in zip(first[:2], values[:2], strict=True))
            if rec in current and ts < current[rec]:
                out[n] = ("STALE", "STALE_REPLAY" if first else "STALE_NEW_VERSION")
            elif first and conflict:
                out[n] = ("QUARANTINED", "VERSION_CONFLICT_SAME_TS")
            elif first:
                out[n] = ("DUPLICATE", "DUPLICATE_OF_HELD_VERSION" if ts in before.get(rec, ()) else "DUPLICATE_IN_BATCH")
            else:
                out[n] = ("NEW_VERSION", None)
            if first is None:
                versions[ts] = values
                added.setdefault(rec, {})[ts] = n
        for rec, ts in added.items():
            if rec not in current:
                out[ts[min(ts)]] = ("NEW_ENCOUNTER", None)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_rules(spark, seed):
    rows = rows_of(seed)
    want = by_hand(rows)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = history.classify_history(df, **ARGS)
    assert {r["row"]: (r["outcome"], r["outcome_reason"]) for r in whole.collect()} == want
    held = df.limit(0)
    for b in range(4):
        one = history.classify_batch(df.filter(F.col("batch") == b), held, **ARGS).cache()
        assert {r["row"]: (r["outcome"], r["outcome_reason"]) for r in one.collect()} == {r[2]: want[r[2]] for r in rows if r[0] == b}
        held = held.unionByName(history.new_versions(one).select(*df.columns))


def test_one_exchange(spark):
    plan = history.classify_history(spark.createDataFrame(rows_of(0), SCHEMA), **ARGS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_match_types(spark):
    rows = [(0, "f", 1, "p", 1, "x", "u", "1"), (0, "f", 2, "p", 1, "x", "u", "1"), (0, "f", 3, "p", 1, "x", None, "01"), (0, "f", 4, "p", 1, "y", "u", "1")]
    got = history.classify_history(spark.createDataFrame(rows, SCHEMA), **ARGS).orderBy("row").collect()
    assert [r["match_type"] for r in got] == [None, "EXACT", "EQUIVALENT", "CONFLICT"]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert history.classify_history(empty, **ARGS).count() == 0
    assert history.current_state(empty, ["rec"], "ts", ["file", "row"], "batch").count() == 0
