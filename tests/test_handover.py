"""The hand-over from a snapshot to the log: replayed, it gives the table that the whole log gives."""

import random

import pytest

from tidemill.sources.handover import change_source

ROW = "map<string,string>"
LOG = f"id long, chunk long, position long, op string, before {ROW}, after {ROW}"


def _apply(changes):
    table = {}
    for key, _, op, after in sorted(changes, key=lambda c: (c[0], c[1])):
        if op == "d":
            table.pop(key, None)
        else:
            table[key] = after
    return table


@pytest.mark.parametrize("seed", range(4))
def test_replay_gives_the_table_of_the_whole_log(spark, seed):
    rnd = random.Random(seed)
    log, state, marks = [], {}, {c: (c * 40, c * 40 + rnd.choice([0, 1, 60])) for c in range(5)}
    snapshot = []
    reads = {key: rnd.randint(*marks[key // 10]) for key in range(50)}  # each row is read somewhere between the marks
    for position in range(1, 400):
        key = rnd.randrange(50)
        for k, at in reads.items():
            if at == position - 1 and k in state:
                snapshot.append((k, k // 10, {"v": state[k]}))
        before = state.get(key)
        op = "c" if before is None else rnd.choice("uud")
        if op == "d":
            state.pop(key)
        else:
            state[key] = str(position)
        log.append((key, key // 10, position, op, before and {"v": before}, None if op == "d" else {"v": state[key]}))
    frames = (spark.createDataFrame(log, LOG), spark.createDataFrame(snapshot, f"id long, chunk long, after {ROW}"),
              spark.createDataFrame([(c, *m) for c, m in marks.items()], "chunk long, low long, high long"))
    told = [(r.id, r.position, r.op, r.after) for r in change_source("initial", frames[0], ["id"], frames[1], frames[2]).collect()]
    whole = [(r[0], r[2], r[3], r[5]) for r in log]
    assert _apply(told) == _apply(whole)
    firsts = [t for t in told if t[2] == "r"]
    assert len({t[0] for t in firsts}) == len(firsts) and all(p == marks[k // 10][1] for k, p, _, _ in firsts)
    later = {t[:3] for t in told if t[2] != "r"}
    assert later == {t[:3] for t in whole if t[1] > marks[t[0] // 10][1]}
    earliest = change_source("earliest", frames[0], ["id"])
    assert earliest.count() == len(log) and "chunk" not in earliest.columns


def test_empty_inputs_and_wrong_modes(spark):
    log = spark.createDataFrame([], LOG)
    snapshot = spark.createDataFrame([(1, 0, {"v": "a"})], f"id long, chunk long, after {ROW}")
    marks = spark.createDataFrame([(0, 5, 9)], "chunk long, low long, high long")
    assert [(r.id, r.position, r.op, r.after) for r in change_source("initial", log, ["id"], snapshot, marks).collect()] == [(1, 9, "r", {"v": "a"})]
    assert change_source("initial", log, ["id"], snapshot.limit(0), marks).count() == 0
    for start, more in (("latest", ()), ("initial", ())):
        with pytest.raises(ValueError):
            change_source(start, log, ["id"], *more)
