"""A run's summary and retries: streams in any micro-batches, over restarts, give what one pass over all events gives."""

import datetime as dt
import random
from collections import Counter

import pytest

from presswork.streaming import runs, streams

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
EVENTS = "config_id string, seq long, ts timestamp, kind string, n long, error string"
ATTEMPTS = "id long, seq long, ts timestamp, good boolean"


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = {k: spark.conf.get(k, None) for k in (name, "spark.sql.shuffle.partitions")}
    spark.conf.set(name, streams.ROCKSDB)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def through(spark, folder, schema, batches, build, name):
    """Rows of a stream that is stopped and started again after every batch."""
    out = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}-in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/{name}-in")
        streams.run_available(build(stream), lambda b, _: out.extend(b.collect()), f"{folder}/{name}-state")
    return out


def summaries_by_hand(events, limit, clock):
    out = []
    for run in sorted({str(e[0]) for e in events}):
        own = sorted((e for e in events if str(e[0]) == run), key=lambda e: (e[2], e[1]))
        deadline = own[0][2] + dt.timedelta(seconds=limit)
        c, end, errors, done = Counter(), own[0][2], Counter(), False
        for _, _, ts, kind, n, error in own:
            if ts > deadline:
                break
            c[kind] += n if kind == runs.FOUND else 1
            end = ts
            if error:
                errors[error] += 1
            if c[runs.LISTED] and c[runs.FOUND] == c["ok"] + c["parse_failed"] + c["download_failed"]:
                done = True
                break
        if done or clock > deadline:
            named = ",".join(f"{k}:{v}" for k, v in sorted(errors.items()))
            out.append((run, int(own[0][2].timestamp()), int(end.timestamp()), c[runs.FOUND], c["ok"], c["parse_failed"], c["download_failed"], done, named))
    return out


def test_summaries_come_once_whatever_the_batches(spark, rocksdb, tmp_path):
    rng = random.Random(4)
    events, seq = [], 0
    for run in range(9):
        minute = run
        left = rng.randint(1, 5)
        lines = [(runs.FOUND, left, None)] + [(rng.choice(["ok", "parse_failed", "download_failed"]), None, rng.choice([None, "E1", "E2"])) for _ in range(left - (run % 3 == 0))]
        lines.insert(rng.randint(1, len(lines)), (runs.LISTED, None, None))
        lines += [("ok", None, "late")] * (run % 2)
        for kind, n, error in lines:
            events.append((None if run == 8 else str(run), seq, at(minute), kind, n, error))
            minute, seq = minute + rng.randint(0, 9), seq + 1
    events.append(("99", 999, at(500), runs.FOUND, 1, None))
    events.sort(key=lambda e: (e[2], e[1]))
    want = summaries_by_hand(events, 3600, at(500))
    assert {w[7] for w in want} == {True, False}
    cuts = {"one": [events], "many": [events[k : k + 13] for k in range(0, len(events), 13)]}
    for name, batches in cuts.items():
        got = through(spark, tmp_path, EVENTS, batches, lambda s: runs.completed(s, 3600), name)
        assert sorted(map(tuple, got)) == want, name


def retries_by_hand(attempts, wait, most, clock):
    out = []
    for i in sorted({a[0] for a in attempts if a[0] is not None}):
        failures, due = 0, None
        for _, _, ts, good in sorted((a for a in attempts if a[0] == i), key=lambda a: (a[2], a[1])):
            if due is not None and due < ts:
                out.append((i, int(due.timestamp()), failures, runs.RETRY))
            due = None
            failures = 0 if good else failures + 1
            if failures == most:
                out.append((i, int(ts.timestamp()), most, runs.DROPPED))
                failures = 0
            elif failures:
                due = ts + dt.timedelta(seconds=wait)
        if due is not None and due < clock:
            out.append((i, int(due.timestamp()), failures, runs.RETRY))
    return out


def test_ids_are_tried_again_when_due(spark, rocksdb, tmp_path):
    rng = random.Random(5)
    attempts = [(rng.choice([*range(6), None]), k, at(3 * k), rng.choice([True, False, False, None])) for k in range(60)] + [(7, 100, at(400), True)]
    want = sorted(retries_by_hand([(*a[:3], bool(a[3])) for a in attempts], 1200, 3, at(400)))
    assert {w[3] for w in want} == {runs.RETRY, runs.DROPPED}
    for name, size in (("one", 100), ("many", 21)):
        got = through(spark, tmp_path, ATTEMPTS, [attempts[k : k + size] for k in range(0, len(attempts), size)], lambda s: runs.retries(s, 1200, 3), name)
        assert sorted(map(tuple, got)) == want, name


def test_ids_of_a_group_share_a_state(spark, rocksdb, tmp_path):
    """Many ids are few groups: state and its calls are counted by group, not by id."""
    rng = random.Random(6)
    attempts = [(rng.randrange(700), k, at(k), rng.random() < 0.3) for k in range(4000)] + [(9999, 5000, at(4400), True)]
    want = sorted(retries_by_hand(attempts, 60_000, 3, at(4400)))
    assert {(w[2], w[3]) for w in want} == {(1, runs.RETRY), (2, runs.RETRY), (3, runs.DROPPED)}
    got = through(spark, tmp_path, ATTEMPTS, [attempts[k : k + 1500] for k in range(0, len(attempts), 1500)], lambda s: runs.retries(s, 60_000, 3, groups=5), "groups")
    assert sorted(map(tuple, got)) == want
    kept = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{tmp_path}/groups-state")
    assert 0 < kept.count() <= 5


def test_streams_without_rows_give_none(spark, rocksdb, tmp_path):
    assert through(spark, tmp_path, EVENTS, [[]], lambda s: runs.completed(s, 60), "a") == []
    assert through(spark, tmp_path, ATTEMPTS, [[]], lambda s: runs.retries(s, 60, 2), "b") == []
