import datetime as dt
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import temporal
from tidegraph.shared import folders
from tidegraph.streaming import imports, state

SIGNAL = "seq long, ts timestamp_ntz, n int"
LOG = "edge_id string, commit_seq long, event_ord int, op string, n int"


def hour(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def test_every_signal_comes_out_with_a_verdict(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    batches = [
        ([(1, hour(0), 1), (2, hour(1), 1), (1, hour(0), 2)], ["1 kept", "1 repeated", "2 kept"]),
        ([(3, hour(10), 1), (2, hour(1), 2)], ["2 repeated", "3 kept"]),
        # the watermark is at hour 9 now
        ([(4, hour(2), 1), (5, hour(11), 1), (3, hour(10), 2)], ["3 repeated", "4 late", "5 kept"]),
        ([(4, hour(2), 2), (6, hour(30), 1), (7, None, 1)], ["4 late", "6 kept", "7 late"]),
        # seq 1 is forgotten: nothing can tell this from a late first sighting
        ([(1, hour(0), 9)], ["1 late"]),
    ]
    sent, want = 0, Counter()
    for rows, told in batches:
        spark.createDataFrame(rows, SIGNAL).coalesce(1).write.mode("append").parquet(source)
        state.start_sightings(spark.readStream.schema(SIGNAL).parquet(source), target, checkpoint).awaitTermination()
        sent += len(rows)
        want.update(told)
        got = state.judged(spark, target)
        assert Counter(f"{r.seq} {r.verdict}" for r in got.collect()) == want and got.count() == sent
    assert sorted(r.seq for r in state.judged(spark, target, "kept").collect()) == [1, 2, 3, 5, 6]


def test_keys_of_a_run_share_one_state(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    sent = lambda rows: spark.createDataFrame(rows, SIGNAL).coalesce(1).write.mode("append").parquet(source)
    start = lambda: state.start_sightings(spark.readStream.schema(SIGNAL).parquet(source), target, checkpoint)
    sent([(n, hour(n % 3), 1) for n in range(-256, 512)])
    query = start()
    query.awaitTermination()
    # three runs of 256 keys, each with a state and a timer, which is kept in two orders
    assert 3 <= max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 9
    # the watermark is at hour 1 now: of a run, keys of hour 0 are forgotten and all others are not
    sent([(n, hour(n % 3), 2) for n in range(-256, 512)])
    start().awaitTermination()
    want = Counter({("kept", 1): 768, ("late", 2): 256, ("repeated", 2): 512})
    assert Counter((r.verdict, r.n) for r in state.judged(spark, target).collect()) == want


def test_a_ledger_applies_what_is_later_and_refuses_what_contradicts(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    batches = [
        ([("a", 2, 0, "assert", 1), ("a", 1, 0, "assert", 1), ("b", 1, 0, "assert", 1)], ["a applied", "a applied", "b applied"]),
        ([("a", 2, 0, "assert", 1), ("a", 2, 0, "assert", 9), ("b", 0, 5, "retract", 1)], ["a repeated", "a refused", "b late"]),
        ([("a", 2, 1, "retract", 1), ("a", 3, 0, "assert", 4), ("b", 2, 0, "retract", 1)], ["a applied", "a applied", "b applied"]),
    ]
    want = Counter()
    for rows, told in batches:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        state.start_ledger(spark.readStream.schema(LOG).parquet(source), target, checkpoint).awaitTermination()
        want.update(told)
        assert Counter(f"{r.edge_id} {r.verdict}" for r in state.judged(spark, target).collect()) == want
    assert [(r.edge_id, r.n) for r in state.state_of(spark, target).collect()] == [("a", 4)]


def test_a_folded_state_survives_compaction(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    dice, sent = random.Random(1), []
    for commit in range(1, 5):
        rows = [(dice.choice("abcdef"), commit, i, dice.choice(["assert", "assert", "retract"]), i) for i in range(5)]
        sent += rows
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        imports.start_fold(spark.readStream.schema(LOG).parquet(source), target, checkpoint).awaitTermination()
        want = sorted(map(tuple, temporal.fold(spark.createDataFrame(sent, LOG)).collect()))
        assert sorted(map(tuple, imports.folded(spark, target).select(*(x.split()[0] for x in LOG.split(", "))).collect())) == want
        if commit > 1:
            assert imports.compact_folded(spark, target) == commit - 1
            assert sorted(map(tuple, imports.folded(spark, target).select(*(x.split()[0] for x in LOG.split(", "))).collect())) == want
        assert imports.published(spark, target) == commit
    # batches up to the last compaction but one are gone, and so is what that had replaced
    assert [n for n in folders(spark, target) if "=" in n] == ["batch=3", "upto=2", "upto=3"]
    assert imports.compact_folded(spark, target) == 3


def test_reads_see_what_is_published_or_wait(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    log = spark.createDataFrame([("a", 1, 0, "assert", 1), ("b", 2, 0, "assert", 1)], LOG)
    assert imports.published(spark, target) == 0
    with pytest.raises(imports.NotYetVisible):
        imports.read_state(log, target, min_indexed_seq=1)
    log.where("commit_seq = 1").write.parquet(source)
    imports.start_fold(spark.readStream.schema(LOG).parquet(source), target, checkpoint).awaitTermination()
    read = lambda **o: sorted(r.edge_id for r in imports.read_state(log, target, **o).collect())
    assert read() == read(min_indexed_seq=1) == ["a"] and read(consistency="strong", min_indexed_seq=2) == ["a", "b"]
    for wrong in ({"min_indexed_seq": 2}, {"consistency": "strong", "min_indexed_seq": 3}):
        with pytest.raises(imports.NotYetVisible):
            read(**wrong)


def test_old_files_are_imported(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    os.mkdir(source)

    def arrive(name, days):
        line = {"source": {"type": "A", "key": name, "name": name}, "relation": "r", "target": {"type": "B", "key": "1", "name": "1"}}
        with open(f"{source}/{name}.json", "w") as file:
            file.write(json.dumps(line) + "\n")
        at = dt.datetime.now().timestamp() - days * 86_400
        os.utime(f"{source}/{name}.json", (at, at))

    for name, days in (("new", 0), ("old", 30), ("older", 900)):
        arrive(name, days)
        assert imports.wait(imports.start_import(spark, source, target, checkpoint)) == "succeeded"
    assert imports.imported(spark, target).select(F.count_distinct("src")).first()[0] == 3


def test_one_generation_needs_no_fold(spark, tmp_path):
    spark.createDataFrame([("e", 1, 0, "assert")], "edge_id string, commit_seq long, event_ord int, op string").write.parquet(f"{tmp_path}/a")
    plan = lambda paths: imports._last(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan([f"{tmp_path}/a"])
    assert "Aggregate" in plan([f"{tmp_path}/a", f"{tmp_path}/a"])


def test_a_folded_stream_has_no_second_copy_of_its_state(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "stream"))
    # events of an edge come several at once, late ones after later ones, and a compaction between
    batches = [[("a", 1, 0, "assert", 1), ("a", 1, 1, "assert", 2), ("b", 5, 0, "assert", 3)], [("b", 4, 0, "retract", 4), ("a", 1, 2, "retract", 5), ("c", 6, 0, "assert", 6)], [("a", 1, 0, "assert", 7), ("c", 7, 0, "retract", 8)]]
    want = [[("a", 2), ("b", 3)], [("b", 3), ("c", 6)], [("b", 3)]]
    for rows, state_then in zip(batches, want, strict=True):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        query = imports.start_fold(spark.readStream.schema(LOG).parquet(source), target, checkpoint)
        query.awaitTermination()
        assert not any(p["stateOperators"] for p in query.recentProgress) and not os.path.exists(f"{checkpoint}/state")
        for _ in range(2):
            assert sorted((r.edge_id, r.n) for r in imports.folded(spark, target).collect()) == state_then
            imports.compact_folded(spark, target)
    assert [n for n in folders(spark, target) if "=" in n] == ["batch=2", "upto=1", "upto=2"]
