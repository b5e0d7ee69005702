"""The running count keeps its state in few partitions and reads each
micro-batch once, so what its tasks report does not follow the session's
shuffle partitions."""

from __future__ import annotations

import pytest

from ratelake.sources.topic import TopicSpec, publish
from ratelake.streaming import consumer
from ratelake.streaming.consumer import ConsumerPaths, drain, latest_snapshot, parsed_stream, run_consumer, start_count
from ratelake.streaming.state import state_operators, state_table, stop_after

SHUFFLE = "spark.sql.shuffle.partitions"
#: one file each: a key that comes back, keys that do not, rows without key
GOES = [["A", "A", "B", None], ["A", "C"], [None, "D", "D"]]
WANT = {"A": 3, "B": 1, "C": 1, "D": 2, None: 2}


@pytest.fixture()
def wide(spark):
    """The session has more shuffle partitions than a running count needs."""
    before = spark.conf.get(SHUFFLE)
    spark.conf.set(SHUFFLE, "24")
    yield spark
    assert spark.conf.get(SHUFFLE) == "24"  # it is the session's own again
    spark.conf.set(SHUFFLE, before)


def _topic(spark, root: str) -> TopicSpec:
    spec = TopicSpec(kind="files", path=f"{root}/topic")
    for go in GOES:
        rows = ['{"country": null}' if c is None else f'{{"country": "{c}"}}' for c in go]
        publish(spark.createDataFrame([(r,) for r in rows], "value string"), spec, files=1)
    return spec


def _dict(counts) -> dict:
    rows = counts.collect()
    assert len({r["country"] for r in rows}) == len(rows)
    return {r["country"]: r["count"] for r in rows}


def _states(query) -> list:
    return [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"] > 0]


def test_update_mode_takes_a_micro_batch_once(wide, tmp_shared):
    start = dict(checkpoint=f"{tmp_shared}/ck", mode="update", snapshot_path=f"{tmp_shared}/snap")
    query = drain(start_count(parsed_stream(wide, _topic(wide, tmp_shared), max_per_trigger=1), **start))
    states = _states(query)
    # a second pass over the batch would count its changed keys again
    assert sum(s["numRowsUpdated"] for s in states) == sum(len(set(go)) for go in GOES)
    assert {s["numShufflePartitions"] for s in states} == {8}
    assert _dict(latest_snapshot(wide, f"{tmp_shared}/snap")) == WANT


def test_a_restart_keeps_the_state_in_its_partitions(wide, tmp_shared):
    spec = _topic(wide, tmp_shared)
    start = dict(checkpoint=f"{tmp_shared}/ck", mode="update", snapshot_path=f"{tmp_shared}/snap")
    parsed = lambda: parsed_stream(wide, spec, max_per_trigger=1)
    stop_after(start_count(parsed(), trigger=None, **start), 2)
    # a checkpoint is bound to its number, whatever the next start asks for
    drain(start_count(parsed(), state_partitions=5, **start))
    assert state_operators(wide, f"{tmp_shared}/ck").first()["numPartitions"] == 8
    assert _dict(state_table(wide, f"{tmp_shared}/ck")) == _dict(latest_snapshot(wide, f"{tmp_shared}/snap")) == WANT


def test_the_consumer_counts_in_few_state_partitions(wide, tmp_shared):
    spec, paths = _topic(wide, tmp_shared), ConsumerPaths(f"{tmp_shared}/out")
    queries = run_consumer(wide, spec, paths.root, max_per_trigger=1, timeout_s=300)
    assert {s["numShufflePartitions"] for s in _states(queries[2])} == {8}
    assert _dict(latest_snapshot(wide, paths.counts)) == WANT
    assert wide.read.parquet(paths.audit).count() == sum(map(len, GOES))


@pytest.mark.parametrize("session, asked, got", [("24", None, 8), ("24", 30, 30), ("3", None, 3)])
def test_state_partitions_of_the_complete_count(wide, tmp_shared, session, asked, got):
    spec = _topic(wide, tmp_shared)
    wide.conf.set(SHUFFLE, session)
    try:
        start = dict(checkpoint=f"{tmp_shared}/ck", snapshot_path=f"{tmp_shared}/snap", state_partitions=asked)
        drain(start_count(parsed_stream(wide, spec, max_per_trigger=1), **start))
        assert wide.conf.get(SHUFFLE) == session
    finally:
        wide.conf.set(SHUFFLE, "24")
    assert state_operators(wide, f"{tmp_shared}/ck").first()["numPartitions"] == got
    assert _dict(latest_snapshot(wide, f"{tmp_shared}/snap")) == WANT


def test_a_start_that_fails_gives_the_session_its_partitions_back(wide):
    with pytest.raises(RuntimeError, match="no start"), consumer.state_in(wide, 2):
        assert wide.conf.get(SHUFFLE) == "2"
        raise RuntimeError("no start")
    assert wide.conf.get(SHUFFLE) == "24"
