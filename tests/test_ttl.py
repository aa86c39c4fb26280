"""Expiry along the records' clock against a machine that keeps one state a key."""

import random

import pytest

from tidemill.operators import ttl as W

DAY = 86_400_000


def _rows(seed):
    rnd, at, rows = random.Random(seed), 0, []
    for n in range(600):
        at += rnd.choice([0, 1_000, 500_000, 5_000_000])
        rows.append((rnd.choice(["hot", "hot", "a", "b", None]), n, at, rnd.randrange(at - 2 * DAY, at + 1), rnd.randrange(100)))
    return rows


def _machine(rows, ttl, step):
    """Feed records to ``step(state, row) -> state``; a state is gone ``ttl`` after its last write."""
    held = {}
    for row in rows:
        state, written = held.get(row[0], (None, None))
        if written is not None and row[2] - written >= ttl:
            state = None
        held[row[0]] = (step(state, row), row[2])


@pytest.mark.parametrize("seed,ttl,hot", [(1, 4_000_000, None), (2, 500_000, 40), (3, 20_000_000, 7), (4, 1, None)])
def test_operators_against_a_machine_of_records(spark, seed, ttl, hot):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "key string, n long, at long, ts long, amount long").repartition(5)
    order = lambda x: repr(x)

    fired = []

    def gate(state, r):
        day = r[3] // DAY
        fired.append((r[1], int(state is None or state != day)))
        return day

    _machine(rows, ttl, gate)
    assert sorted((r.n, r.uv_ct) for r in W.daily_unique_with_ttl(df, ["key"], "n", "ts", "at", ttl, hot_rows=hot).collect()) == fired

    passed = []

    def latest(state, r):
        if state is None or r[3] > state:
            passed.append(r[1])
        return r[3] if state is None else max(state, r[3])

    _machine(rows, ttl, latest)
    assert sorted(r.n for r in W.monotone_with_ttl(df, ["key"], "n", "ts", "at", ttl, hot).collect()) == passed

    told = []

    def retract(state, r):
        if state is not None:
            told.append((state[1], -state[4], 1))
        told.append((r[1], r[4], 0))
        return r

    _machine(rows, ttl, retract)
    got = [(r.n, r.amount, r.is_retract) for r in W.retract_with_ttl(df, ["key"], "n", ["amount"], "at", ttl, hot).collect()]
    assert sorted(got, key=order) == sorted(told, key=order)


def test_no_rows_and_no_clock(spark):
    df = spark.createDataFrame([("a", 1, None, 5, 1), ("a", 2, 10**9, 4, 2)], "key string, n long, at long, ts long, amount long")
    assert W.with_lives(df.limit(0), ["key"], ["n"], "n", "at", 10).count() == 0
    assert len({r.life for r in W.with_lives(df, ["key"], ["n"], "n", "at", 10).collect()}) == 1
