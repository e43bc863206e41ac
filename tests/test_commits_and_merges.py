import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import ontology, temporal, writes
from tidegraph.operators.ontology import Ontology, Relation

LOG = "edge_id string, src string, relation string, dst string, commit_seq long, valid_from timestamp_ntz, op string, event_ord int, price int"
CONTENT = "edge_id string, src string, relation string, dst string, valid_from timestamp_ntz, op string, event_ord int, price int"


def event(edge, seq, op="assert", order=0, price=1, day=1, src="A/1", dst="B/1"):
    return (edge, src, "r", dst, seq, dt.datetime(2024, 1, day), op, order, price)


def log_of(spark, *events):
    return spark.createDataFrame(list(events), LOG)


def state(log):
    return {(r.edge_id, r.price) for r in temporal.fold(log).collect()}


def test_a_commit_keeps_all_events_of_an_edge_in_their_order(spark, tmp_path):
    path = f"{tmp_path}/log"
    events = log_of(spark, event("e", 1), event("e", 1, "retract", 1), event("e", 1, "assert", 2, price=5))
    assert writes.commit(events, events.limit(0), path).op_count == 3
    stored = spark.read.parquet(path).select(*events.columns)
    assert state(stored) == {("e", 5)}
    assert writes.commit(events.unionByName(events), stored, path) == writes.Ack(1, 0, 0, True, True)


def test_two_contents_under_one_key_raise(spark, tmp_path):
    twice = log_of(spark, event("e", 1), event("e", 1, price=2))
    with pytest.raises(ValueError):
        writes.commit(twice, twice.limit(0), f"{tmp_path}/log")
    known = log_of(spark, event("e", 1, price=None))
    assert writes.conflicts(log_of(spark, event("e", 1)), known, writes.EVENT_KEY).count() == 1
    assert writes.conflicts(known, known, writes.EVENT_KEY).count() == 0


def test_groups_of_keys_say_what_each_key_says_or_nothing(spark):
    old = [event("a", 1), event("a", 1, "retract", 1), event("b", 1, price=None), event("c", 1)]
    log = log_of(spark, *old)
    of = lambda *rows: (log_of(spark, *rows), log, writes.EVENT_KEY)
    new = [event("a", 2), event("a", 2, "retract", 1), event("a", 2, order=2), event("d", 1)]
    for rows in ([], old, new, new + old[2:], old[::-1]):
        assert writes._weighed_by_group(*of(*rows)) == writes._weighed_by_key(*of(*rows)) is not None
    # in part known, other content, twice the same, two contents, more keys than places, a null in a key
    doubts = [old[:1], [event("b", 1)], [event("e", 1)] * 2, [event("e", 1), event("e", 1, price=2)], [event("e", 1), event("e", 1, order=32)], [event("e", 1, order=None), event("e", 1)]]
    for rows in doubts:
        assert writes._weighed_by_group(*of(*rows)) is None
        assert writes._weighed(*of(*rows)) == writes._weighed_by_key(*of(*rows))
    named = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    assert writes._weighed_by_group(named, named.limit(1), ["k"]) == {"sent": 2, "given": 2, "lacking": 1, "doubtful": 0}


def test_only_what_is_wholly_unchanged_is_skipped(spark):
    log = log_of(spark, *(event(e, 1) for e in "abcdef"))
    sent = log_of(
        spark, event("a", 2), event("b", 2, price=9), event("c", 2, day=2), event("d", 2, "retract"), event("d", 2, "assert", 1), event("e", 2, price=9), event("e", 2, "assert", 1), event("f", 2), event("f", 3), event("new", 2)
    )
    assert sorted((r.edge_id, r.event_ord) for r in writes.skip_current(sent, log).collect()) == [("b", 0), ("c", 0), ("d", 0), ("d", 1), ("e", 0), ("e", 1), ("new", 0)]
    # named columns alone decide, if there are any
    assert {r.edge_id for r in writes.skip_current(sent, log, ["src", "dst"]).collect()} == {"d", "new"}


def test_each_event_travels_once_when_unchanged_ones_are_skipped(spark):
    log = log_of(spark, *(event(e, 1) for e in "abc"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = writes.skip_current(log, log)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(edge_id") == plan.count("Exchange ") == 2


def test_a_digest_is_of_a_multiset(spark):
    one = spark.createDataFrame([("e", "A", "r", "B", None, "assert", 0, 1), ("f", "A", "r", "B", None, "assert", 0, None)], CONTENT)
    of = lambda df: tuple(writes.digests(df).first())
    assert of(one) == of(one.repartition(3)) == of(one.orderBy(F.desc("edge_id"))) == of(one.select(*reversed(one.columns)))
    assert len({of(one), of(one.unionByName(one)), of(one.limit(1)), of(one.withColumn("price", F.coalesce("price", F.lit(0)))), of(one.limit(0))}) == 5


def test_keys_are_bound_to_content(spark, tmp_path):
    path = f"{tmp_path}/log"
    first = spark.createDataFrame([("e", "A", "r", "B", None, "assert", 0, 1), ("f", "A", "r", "B", None, "assert", 0, 1)], CONTENT)
    other = first.withColumn("price", F.lit(2))
    assert writes.commit_once(first, path, "k1") == writes.Ack(1, 2, 0, False, False)
    assert writes.commit_once(first.repartition(2), path, "k1") == writes.Ack(1, 0, 0, True, True)
    with pytest.raises(writes.KeyReused):
        writes.commit_once(other, path, "k1")
    assert writes.commit_once(other, path, "k2").commit_seq == 2
    log = writes.committed(spark, path, f"{CONTENT}, commit_seq long")
    assert log.count() == 4 and state(log) == {("e", 2), ("f", 2)}
    # events of a commit that never reached the ledger are no part of the log, and the next commit replaces them
    other.withColumn("commit_seq", F.lit(3).cast("long")).write.parquet(f"{path}/events/commit=3")
    assert writes.committed(spark, path, f"{CONTENT}, commit_seq long").count() == 4
    assert writes.commit_once(first.limit(1), path, "k3") == writes.Ack(3, 1, 0, False, False)
    assert writes.committed(spark, path, f"{CONTENT}, commit_seq long").count() == 5


def test_an_empty_ledger_and_null_keys(spark, tmp_path):
    assert writes.ledger(spark, f"{tmp_path}/none").count() == 0
    assert writes.committed(spark, f"{tmp_path}/none", f"{CONTENT}, commit_seq long").count() == 0
    sent = writes.digests(spark.createDataFrame([("k", 1), (None, 2)], "commit_key string, n int"), "commit_key")
    assert {r.commit_key: r.verdict for r in writes.judge(sent, sent.where("commit_key = 'k'")).collect()} == {"k": "replay", None: "new"}


# ------------------------------------------------------------------ merges


def parted(spark):
    trunk = log_of(
        spark, *(event(e, 1) for e in ("same", "ours", "theirs", "alike", "apart", "gone_both", "gone_ours", "gone_changed", "back")),
        event("theirs", 3, price=2), event("alike", 3, price=3), event("apart", 3, price=4), event("gone_both", 3, "retract"), event("gone_changed", 4, price=5), event("new_alike", 4), event("new_apart", 4, price=6),
    )
    own = log_of(
        spark, event("ours", 2, price=7), event("alike", 5, price=3), event("apart", 2, price=8), event("gone_both", 2, "retract"), event("gone_ours", 2, "retract"), event("gone_changed", 2, "retract"),
        event("new_alike", 9), event("new_apart", 2), event("new_ours", 2), event("back", 2, price=9), event("back", 3),
    )
    return trunk, own


def test_a_merge_takes_what_only_the_branch_changed(spark):
    trunk, own = parted(spark)
    done = writes.merge_three_way(trunk, own, 1)
    assert done.counts == {"clean": 3, "equal": 3, "conflict": 3, "parent only": 1}
    assert {(r.edge_id, r.op, r.commit_seq) for r in done.events.collect()} == {("ours", "assert", 5), ("gone_ours", "retract", 5), ("new_ours", "assert", 5)}
    told = {r.edge_id: (r.base and r.base.price, r.parent and r.parent.price, r.branch and r.branch.price) for r in done.conflicts.collect()}
    assert told == {"apart": (1, 4, 8), "gone_changed": (1, 5, None), "new_apart": (None, 6, 1)}
    after = trunk.unionByName(done.events)
    assert state(after) == {("same", 1), ("ours", 7), ("theirs", 2), ("alike", 3), ("apart", 4), ("gone_changed", 5), ("new_alike", 1), ("new_apart", 6), ("new_ours", 1), ("back", 1)}
    # merged again, there is nothing left to take
    assert writes.merge_three_way(after, own, 1).counts["clean"] == 0
    preferred = state(trunk.unionByName(writes.merge_three_way(trunk, own, 1, prefer="branch").events))
    assert {("apart", 8), ("new_apart", 1)} <= preferred and not [e for e, _ in preferred if e == "gone_changed"]
    with pytest.raises(ValueError):
        writes.merge_three_way(trunk, own, 1, prefer="both")


def test_a_merge_checks_the_state_that_it_makes(spark):
    trunk = log_of(spark, event("x", 1), event("y", 3, dst="B/2"))
    own = log_of(spark, event("z", 2, dst="B/3"))
    rules = lambda n, kinds="B": ontology.as_table(spark, Ontology(relations={"r": Relation(frozenset("A"), frozenset(kinds), n)}))
    assert writes.merge_three_way(trunk, own, 1, rules=rules(3)).counts["clean"] == 1
    # two edges on either side are allowed, three together are not
    with pytest.raises(ValueError):
        writes.merge_three_way(trunk, own, 1, rules=rules(2))
    with pytest.raises(ValueError):
        writes.merge_three_way(trunk, own, 1, rules=rules(None, "C"))
    gone = own.unionByName(log_of(spark, event("x", 2, "retract")))
    assert writes.merge_three_way(trunk, gone, 1, rules=rules(2)).counts["clean"] == 2


def test_a_plain_merge_wants_a_parent_that_stood_still(spark):
    trunk, own = log_of(spark, event("x", 1), event("x", 5)), log_of(spark, event("x", 2, price=3))
    with pytest.raises(ValueError):
        writes.merge(trunk, own, 1, 5)
    assert state(writes.merge(trunk.where("commit_seq = 1"), own, 1, 2)) == {("x", 3)}


def test_a_commit_that_is_all_new_or_all_known_moves_no_content(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/log"
    events = log_of(spark, event("e", 1), event("f", 1, price=None), event("e", 2))
    with monkeypatch.context() as m:
        m.setattr(writes, "new_events", lambda *_: pytest.fail("content was compared"))
        m.setattr(writes, "conflicts", lambda *_: pytest.fail("content was compared"))
        assert writes.commit(events, events.limit(0), path) == writes.Ack(2, 3, 0, False, False)
        stored = spark.read.parquet(path).select(*events.columns)
        assert writes.commit(events.repartition(3), stored, path) == writes.Ack(2, 0, 0, True, True)
    with pytest.raises(ValueError):
        writes.commit(log_of(spark, event("f", 1, price=0)), stored, path)
    # known, sent twice, and without a key, which nothing known is equal to
    mixed = log_of(spark, event("e", 1), event("g", 3), event("g", 3), event(None, 3))
    assert writes.commit(mixed, stored, path) == writes.Ack(3, 2, 0, False, False)
    assert spark.read.parquet(path).count() == 5


def test_a_reload_reads_the_log_once(spark, tmp_path):
    log_of(spark, event("same", 1), event("changed", 1), event("gone", 1)).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log").select(*LOG.replace(",", "").split()[::2])
    payload = log_of(spark, event("same", 1), event("changed", 1, price=2), event("added", 1)).drop("commit_seq", "event_ord", "op")
    done = writes.reload(log, payload, ["price"], graph_id="g", confirm="g")
    assert done.counts == {"added": 1, "changed": 1, "removed": 1, "unchanged": 1}
    assert all("tidegraph-diff" in name for name in done.events.inputFiles())
    assert state(log.unionByName(done.events)) == {("same", 1), ("changed", 2), ("added", 1)}


def test_contents_a_microsecond_apart_are_two(spark, tmp_path):
    path = str(tmp_path / "log")
    log = lambda micro: spark.createDataFrame([("e", 1, 0, "CONTAINS", dt.datetime(2020, 1, 1, 0, 0, 0, micro))], "edge_id string, commit_seq long, event_ord int, relation string, valid_from timestamp_ntz")
    writes.commit(log(1), log(1).limit(0), path)
    stored = spark.read.parquet(path).select(*log(1).columns)
    assert writes.commit(log(1), stored, path).idempotent_replay
    with pytest.raises(ValueError, match="more than one content"):
        writes.commit(log(2), stored, path)
