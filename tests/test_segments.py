import random

import pytest

from tidegraph.operators import segments, temporal, writes
from tidegraph.operators.segments import Unit, chosen
from tidegraph.shared import folders

EVENT = "edge_id string, op string, event_ord int, price int"
SCHEMA = f"{EVENT}, commit_seq long"


def sizes(*counts):
    return [Unit(i + 1, i + 1, n) for i, n in enumerate(counts)]


def test_the_tail_is_chosen_by_size():
    assert chosen(sizes(10, 10, 10)) == []
    assert chosen(sizes(1000, 10, 10, 10, 10)) == sizes(1000, 10, 10, 10, 10)[1:]
    assert len(chosen(sizes(100, 10, 10, 10, 10))) == 5
    assert len(chosen(sizes(1000, 10, 10), max_segments=2)) == 2
    assert len(chosen(sizes(1000, 10, 10), max_segments=1)) == 3
    assert chosen([], max_segments=1) == chosen(sizes(5), max_segments=1) == []


def test_work_grows_with_the_tail():
    """Commits of one size: an event is rewritten about as often as the log grows fourfold."""
    now, written = [], 0
    for n in range(1, 1001):
        now.append(Unit(n, n, 10))
        some = chosen(now)
        if some:
            written += sum(u.op_count for u in some)
            now = [*now[: len(now) - len(some)], Unit(some[0].first, some[-1].last, sum(u.op_count for u in some))]
    assert sum(u.op_count for u in now) == 10_000 and len(now) < 25
    assert written < 12 * 10_000


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path, dice, sent = str(tmp_path_factory.mktemp("log")), random.Random(3), []
    for seq in range(1, 8):
        # edges of later commits have later names
        rows = [(f"e{seq * 2 + dice.randrange(4):02}", dice.choice(["assert", "assert", "retract"]), i, seq) for i in range(6)] if seq != 4 else []
        sent += [(*r, seq) for r in rows]
        writes.commit_once(spark.createDataFrame(rows, EVENT), path, f"k{seq}")
        if seq == 5:
            assert segments.compact_tail(spark, path, SCHEMA).last == 5
    return path, sent


def test_histories_and_earlier_reads_stay(spark, log):
    path, sent = log
    assert [(u.first, u.last, u.op_count) for u in segments.units(spark, path)] == [(1, 5, 24), (6, 6, 6), (7, 7, 6)]
    every = lambda **o: sorted(map(tuple, segments.events(spark, path, SCHEMA, **o).select("edge_id", "op", "event_ord", "price", "commit_seq").collect()))
    assert every() == sorted(sent)
    for seq in (0, 1, 3, 5, 6, 7):
        assert every(commit_seq=seq) == sorted(r for r in sent if r[-1] <= seq)
    for edge in {r[0] for r in sent} | {"none"}:
        assert every(edge=edge) == sorted(r for r in sent if r[0] == edge)
    want = temporal.fold(spark.createDataFrame(sent, SCHEMA))
    assert sorted(map(tuple, temporal.fold(segments.events(spark, path, SCHEMA)).collect())) == sorted(map(tuple, want.select(*temporal.fold(segments.events(spark, path, SCHEMA)).columns).collect()))


def test_reads_open_what_they_need_and_sweeping_keeps_it(spark, log):
    path, sent = log
    assert [u.first for u in segments.needed(spark, path, commit_seq=5)] == [1]
    # the segment's edges end before e99 begins; of commits that is not known
    assert [u.first for u in segments.needed(spark, path, edge="e99")] == [6, 7]
    assert segments.compact_tail(spark, path, SCHEMA) is None
    assert segments.sweep(spark, path) == 5
    assert segments.compact_tail(spark, path, SCHEMA, max_segments=1) == Unit(1, 7, 36, min(r[0] for r in sent), max(r[0] for r in sent))
    assert segments.needed(spark, path, edge="e99") == []
    assert segments.sweep(spark, path) == 3 and folders(spark, f"{path}/events") == ["segment=1-7"]
    assert sorted(map(tuple, segments.events(spark, path, SCHEMA).select("edge_id", "op", "event_ord", "price", "commit_seq").collect())) == sorted(sent)
    # a replay is still one, and the next commit goes on
    assert writes.commit_once(spark.createDataFrame([], EVENT), path, "k4").idempotent_replay
    assert writes.commit_once(spark.createDataFrame([("e50", "assert", 0, 1)], EVENT), path, "k8").commit_seq == 8
    assert segments.events(spark, path, SCHEMA).count() == 37


def test_an_empty_log(spark, tmp_path):
    assert segments.units(spark, str(tmp_path)) == [] and segments.compact_tail(spark, str(tmp_path), SCHEMA) is None
    assert segments.events(spark, str(tmp_path), SCHEMA).count() == 0 and segments.sweep(spark, str(tmp_path)) == 0
