import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import entities, intervals, ontology, signals, temporal, writes
from tidegraph.operators.entities import neighbourhood
from tidegraph.operators.ontology import Ontology, Relation, RestrictiveChange
from tidegraph.sources.star import Graph

LOG = "edge_id string, src string, relation string, dst string, commit_seq long, valid_from timestamp_ntz, op string, event_ord int, quantity int"


def day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture(scope="module")
def log(spark):
    """e1 is asserted, retracted and asserted again; e2 is asserted once."""
    return spark.createDataFrame(
        [("e1", "A/1", "r", "B/1", 1, day(1), "assert", 0, 1), ("e1", "A/1", "r", "B/1", 2, day(5), "retract", 0, 1), ("e1", "A/1", "r", "B/1", 3, day(9), "assert", 0, 2), ("e2", "A/2", "r", "B/1", 2, day(2), "assert", 1, 7)], LOG
    )


def ids(df):
    return sorted(r.edge_id for r in df.collect())


def test_fold_and_time_travel(log):
    assert ids(temporal.fold(log)) == ["e1", "e2"]
    assert [ids(temporal.fold(temporal.snapshot(log, commit_seq=n))) for n in (1, 2, 3)] == [["e1"], ["e2"], ["e1", "e2"]]
    assert ids(temporal.fold(temporal.snapshot(log, valid_time="2024-01-06"))) == ["e2"]
    assert [r.place for r in temporal.history(log).where("edge_id = 'e1'").orderBy("place").collect()] == [1, 2, 3]


def test_snapshot_reaches_the_scan(spark, log, tmp_path):
    log.write.parquet(f"{tmp_path}/log")
    plan = temporal.fold(temporal.snapshot(spark.read.parquet(f"{tmp_path}/log"), commit_seq=2))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(commit_seq,2)" in plan


def test_transitions_and_as_of_join(spark):
    states = spark.createDataFrame([("u", "x", day(1)), ("u", "y", day(3)), ("v", "x", day(2))], "src string, dst string, valid_from timestamp_ntz")
    got = {(r.src, r.dst): (r.previous, r.dwell_micros) for r in temporal.transitions(states).collect()}
    assert got == {("u", "x"): (None, 2 * 86_400_000_000), ("u", "y"): ("x", None), ("v", "x"): (None, None)}
    assert {r.src: r.dst for r in temporal.latest(states, as_of="2024-01-02").collect()} == {"u": "x", "v": "x"}
    left = spark.createDataFrame([("u", day(2), 1), ("u", day(3), 2), ("w", day(1), 3)], "src string, at timestamp_ntz, n int")
    joined = temporal.as_of_join(left, states, "src", "at", "valid_from", "dst")
    assert {r.n: r.dst for r in joined.collect()} == {1: "x", 2: "y", 3: None}


def test_buckets_of_a_hot_key_change_nothing(spark):
    dice = random.Random(7)
    rows = [(dice.choice("aab"), day(1) + dt.timedelta(hours=dice.randrange(400)), dice.choice("xyz"), i) for i in range(120)]
    states = spark.createDataFrame(rows, "src string, valid_from timestamp_ntz, dst string, n int")
    plain, dealt = (sorted(map(tuple, temporal.transitions(states, tie="n", bucket_unit=u).collect()), key=str) for u in (None, "day"))
    assert plain == dealt and len(plain) == 120
    assert sum(r[-1] is None for r in plain) == 2 and sum(r[-2] is None for r in plain) == 2
    left = states.select("src", F.col("valid_from").alias("at"), "n")
    right = states.where("n % 4 = 0").withColumn("dst", F.when(F.col("n") % 3 > 0, F.col("dst")))
    one, other = (sorted(map(tuple, temporal.as_of_join(left, right, "src", "at", "valid_from", "dst", bucket_unit=u).collect()), key=str) for u in (None, "day"))
    assert one == other and any(r[-1] for r in one)


def test_retract_by_edge_and_by_entity(spark, log):
    state = temporal.fold(log)
    after = log.unionByName(writes.retract(state, spark.createDataFrame([("e2",)], "edge_id string"), 9).select(*log.columns))
    assert ids(temporal.fold(after)) == ["e1"]
    assert ids(temporal.fold(temporal.snapshot(after, commit_seq=8))) == ["e1", "e2"]
    gone = writes.retract_entities(state, spark.createDataFrame([("B/1",)], "id string"), 9)
    assert ids(temporal.fold(log.unionByName(gone.select(*log.columns)))) == []


def test_reload_counts_and_second_reload_changes_nothing(spark):
    columns = "id string, name string, n int"
    current = spark.createDataFrame([("1", "a", 1), ("2", "b", 1), ("3", "c", None)], columns)
    payload = spark.createDataFrame([("1", "a", 1), ("2", "b", 2), ("4", "d", 1)], columns)
    changes = lambda a, b: {r.id: r.change for r in writes.diff(a, b, "id", ["name", "n"]).collect()}
    assert changes(current, payload) == {"1": "unchanged", "2": "changed", "3": "removed", "4": "added"}
    assert set(changes(payload, payload).values()) == {"unchanged"}


def test_a_value_moved_between_columns_is_a_change(spark):
    columns = "id string, a string, b string"
    one, other = spark.createDataFrame([("1", "x", None)], columns), spark.createDataFrame([("1", None, "x")], columns)
    assert [r.change for r in writes.diff(one, other, "id", ["a", "b"]).collect()] == ["changed"]


def test_reload_gives_the_payload_and_a_way_back(spark, log):
    payload = spark.createDataFrame([("e2", "A/2", "r", "B/1", day(2), 8), ("e3", "A/3", "r", "B/1", day(3), 1)], "edge_id string, src string, relation string, dst string, valid_from timestamp_ntz, quantity int")
    with pytest.raises(ValueError):
        writes.reload(log, payload, ["quantity"], graph_id="g", confirm="other")
    assert writes.reload(log, payload, ["quantity"], graph_id="g", dry_run=True).events.count() == 0
    done = writes.reload(log, payload, ["quantity"], graph_id="g", confirm="g")
    assert done.counts == {"added": 1, "changed": 1, "removed": 1, "unchanged": 0} and done.prior_commit_seq == 3
    after = log.unionByName(done.events)
    assert {(r.edge_id, r.quantity) for r in temporal.fold(after).collect()} == {("e2", 8), ("e3", 1)}
    assert ids(temporal.state(after, commit_seq=done.prior_commit_seq)) == ["e1", "e2"]
    assert writes.reload(after, payload, ["quantity"], graph_id="g", confirm="g").events.count() == 0


def test_edges_end_at_valid_to(spark, log):
    ended = log.withColumn("valid_to", F.when(F.col("edge_id") == "e2", F.lit("2024-01-04").cast("timestamp_ntz")))
    assert [ids(temporal.state(ended, valid_time=f"2024-01-0{d}")) for d in (1, 2, 3, 4)] == [["e1"], ["e1", "e2"], ["e1", "e2"], ["e1"]]
    assert ids(temporal.state(ended)) == ["e1", "e2"]


def test_commit_acknowledges_replays_and_conflicts(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    first = writes.commit(log, log.limit(0), path)
    assert first == writes.Ack(3, 4, 0, False, False)
    stored = spark.read.parquet(path).select(*log.columns)
    assert writes.commit(log, stored, path) == writes.Ack(3, 0, 0, True, True)
    with pytest.raises(ValueError):
        writes.commit(log.withColumn("quantity", F.lit(99)), stored, path)
    later = temporal.fold(log).withColumn("commit_seq", F.lit(9).cast("long")).select(*log.columns)
    assert writes.commit(later, stored, path, skip_unchanged=True) == writes.Ack(3, 0, 2, True, False)
    assert writes.commit(later.withColumn("quantity", F.col("quantity") + 1), stored, path, skip_unchanged=True).op_count == 2


def test_compaction_keeps_history_and_earlier_reads(log):
    packed = writes.compact(log)
    assert sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, log.collect()), key=str)
    for seq in (1, 2, 3):
        assert ids(temporal.state(packed, commit_seq=seq)) == ids(temporal.state(log, commit_seq=seq))
    cut = writes.compact(log, horizon=2)
    assert cut.count() == 3
    assert [ids(temporal.state(cut, commit_seq=seq)) for seq in (2, 3)] == [["e2"], ["e1", "e2"]]


def test_merge_refuses_what_the_ontology_does_not_allow(spark, log):
    trunk, own = log.where("commit_seq <= 1"), log.where("commit_seq > 1")
    allowed, other = (ontology.as_table(spark, Ontology(relations={"r": Relation(frozenset(k), frozenset("B"))})) for k in ("A", "X"))
    assert writes.merge(trunk, own, 1, 2, rules=allowed).count() == 3
    with pytest.raises(ValueError):
        writes.merge(trunk, own, 1, 2, rules=other)


def test_interval_and_range_joins_equal_nested_loops(spark):
    dice = random.Random(3)
    rows = [(i, i % 3, day(1) + dt.timedelta(hours=dice.randrange(900)), dice.choice([None, 0, 1, 5, 40, 30_000])) for i in range(60)]
    made = [(i, k, a, None if n is None else a + dt.timedelta(hours=n)) for i, k, a, n in rows]
    frame = spark.createDataFrame(made, "id int, k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    one, other = frame.where("id < 30"), frame.where("id >= 30")
    end = lambda x: x[3] or dt.datetime.max
    want = {(x[0], y[0]) for x in made[:30] for y in made[30:] if x[1] == y[1] and x[2] < end(x) and y[2] < end(y) and x[2] < end(y) and y[2] < end(x)}
    got = [(r.id, r.r_id) for r in intervals.interval_join(one, other, ["k"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    values = spark.createDataFrame([(dice.uniform(-50, 50),) for _ in range(40)], "v double")
    bands = spark.createDataFrame([(a, a + dice.uniform(-1, 9)) for a in (dice.uniform(-50, 50) for _ in range(30))], "low double, high double")
    brute = {(v.v, b.low) for v in values.collect() for b in bands.collect() if b.low <= v.v <= b.high}
    assert {(r.v, r.low) for r in intervals.range_join(values, bands, "v", "low", "high").collect()} == brute


def test_branch_merge_compact_and_replay(log):
    trunk, own = log.where("commit_seq <= 1"), log.where("commit_seq > 1")
    assert ids(temporal.fold(writes.branch(trunk, own, 1))) == ["e1", "e2"]
    merged = writes.merge(trunk, own, 1, 2)
    assert {(r.edge_id, r.commit_seq) for r in temporal.fold(merged).collect()} == {("e1", 2), ("e2", 2)}
    assert ids(temporal.fold(writes.compact(log))) == ids(temporal.fold(log))
    assert writes.new_events(log, log, ["edge_id", "commit_seq", "op"]).count() == 0


def test_dry_run_reports_unknown_relations_and_wrong_ends(spark, log):
    rules = ontology.as_table(spark, Ontology(relations={"r": Relation(frozenset("A"), frozenset("B"))}))
    wrong = log.withColumn("src", F.when(F.col("edge_id") == "e2", "X/1").otherwise(F.col("src")))
    assert [writes.dry_run(x, rules).first().violations for x in (log, wrong, log.withColumn("relation", F.lit("other")))] == [0, 1, 4]
    two = ontology.as_table(spark, Ontology(relations={"r": Relation(frozenset("AX"), frozenset("BC"))}))
    assert tuple(writes.dry_run(wrong, two).first()) == (4, 2, 0)


def test_ontology_changes():
    base = Ontology(types={"A": None}, relations={"r": Relation(frozenset("A"), frozenset("B"), 2)})
    assert ontology.define(base, base) == (base, False)
    wider, changed = ontology.evolve(base, Ontology(types={"C": "A"}, relations={"r": Relation(frozenset("C"), frozenset("B"), 3)}))
    assert changed and wider.version == 2 and wider.relations["r"] == Relation(frozenset("AC"), frozenset("B"), 3)
    assert ontology.subclasses(wider)["A"] == {"A", "C"}
    for narrower in (Relation(frozenset(), frozenset("B"), 2), Relation(frozenset("A"), frozenset("B"), 1)):
        with pytest.raises(RestrictiveChange):
            ontology.define(base, Ontology(relations={"r": narrower}))


def test_conformance_induction_and_resolution(spark):
    edges = spark.createDataFrame([("A/1", "r", "B/1"), ("A/1", "r", "B/2"), ("A/2", "r", "B/1"), ("A/2", "s", "C/1")], "src string, relation string, dst string")
    rules = ontology.as_table(spark, Ontology(relations={"r": Relation(frozenset("A"), frozenset("B"), 1)}))
    assert [(r.src, r.n) for r in ontology.conformance(edges, rules).collect()] == [("A/1", 2)]
    assert [(r.relation, r.domain, r.range, r.edges, r.max_out) for r in ontology.induce(edges, rules).collect()] == [("s", "A", "C", 1, 1)]
    names = spark.createDataFrame([("N/1", "New Zealand"), ("N/2", "Norway")], "id string, name string")
    mentions = spark.createDataFrame([("new-zealand",), ("norwai",), ("elsewhere",), ("xorway",), ("orwayx",), ("yorwaix",)], "mention string")
    assert {r.mention: (r.id, r.distance) for r in ontology.resolve(mentions, names).collect()} == {"new-zealand": ("N/1", 0), "norwai": ("N/2", 1), "xorway": ("N/2", 1), "orwayx": ("N/2", 2)}
    assert [r.id for r in ontology.search(names, "NOR").collect()] == ["N/2"]


def test_neighbourhood_says_where_it_was_cut(spark):
    edges = spark.createDataFrame([(f"e{i}", "A/1", "r", f"B/{i}") for i in range(5)] + [("f", "B/9", "r", "A/1")], "edge_id string, src string, relation string, dst string")
    got = neighbourhood(edges, spark.createDataFrame([("A/1",)], "id string"), most=3).collect()
    assert sorted((r.direction, r.rank, r.total, r.truncated) for r in got) == [("in", 1, 1, False), ("out", 1, 5, True), ("out", 2, 5, True), ("out", 3, 5, True)]
    with pytest.raises(ValueError):
        neighbourhood(edges, edges, most=0)


def test_entity_detail_and_why(spark, log):
    properties = spark.createDataFrame([("A/1", "one"), ("B/1", "two"), ("C/1", "three")], "id string, name string")
    noted = spark.createDataFrame([("A/1", day(2), "seen"), ("A/1", day(1), "heard")], "id string, at timestamp_ntz, text string")
    got = {r.id: r for r in entities.detail(log, properties, commit_seq=2, observations=noted).collect()}
    assert (got["A/1"].last_commit, got["A/1"].out_edges_total, [h.op for h in got["A/1"].history]) == (2, 0, ["assert", "retract"])
    assert [e.other for e in got["B/1"].in_edges] == ["A/2"] and got["B/1"].history_total == 3
    assert [o.text for o in got["A/1"].observations] == ["heard", "seen"]
    assert (got["C/1"].events, got["C/1"].history, got["C/1"].in_edges_total) == (0, None, 0)
    cut = {r.id: r for r in entities.detail(log, properties, most=1).collect()}
    assert len(cut["B/1"].in_edges) == 1 and cut["B/1"].in_edges_total == 2
    reasons = {r.edge_id: r for r in entities.why(log, spark.createDataFrame([("e1", "ep/1", "Ann said so")], "edge_id string, episode string, text string")).collect()}
    assert [e.op for e in reasons["e1"].lineage] == ["assert", "retract", "assert"] and reasons["e1"].evidence[0].text == "Ann said so"
    assert (reasons["e2"].evidence, reasons["e2"].evidence_total) == (None, 0)


def test_reasons_are_counted_where_they_are_ranked(spark, log):
    evidence = spark.createDataFrame([("e1", f"ep/{i}", "said") for i in (3, 1, 2)] + [(None, "ep/4", "said")], "edge_id string, episode string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = entities.why(log, evidence, most=2)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r.edge_id: r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ([e.episode for e in got["e1"].evidence], got["e1"].evidence_total, len(got["e1"].lineage), got["e1"].lineage_total) == (["ep/1", "ep/2"], 3, 2, 3)
    # one shuffle for the events and one for the evidence
    assert plan.count("Exchange hashpartitioning") == 2


def test_gates_promotions_and_ticks(spark):
    truth = spark.createDataFrame([("q1", "a"), ("q1", "b"), ("q2", "c")], "q string, fact string")
    score = signals.fact_scores(truth.where("fact <> 'b'").unionByName(spark.createDataFrame([("q3", "z")], truth.schema)), truth, ["q", "fact"]).first()
    assert (score.predicted, score.true, score.hits, round(score.f1, 6)) == (3, 3, 2, round(2 / 3, 6))
    slots = spark.createDataFrame([("q1", 1, None), ("q2", 2, "x"), ("q3", 3, "y")], "q string, a int, b string")
    exact = signals.slot_exactness(slots.where("q <> 'q3'").withColumn("a", F.lit(1)), slots, "q", ["a", "b"]).first()
    assert (exact.requests, exact.exact) == (3, 1)
    runs = spark.createDataFrame([("k", 1, "m1"), ("k", 2, "m2")], "kind string, run int, manifest string")
    none = spark.createDataFrame([], "kind string, run int, at long")
    one = signals.promote(runs, none, "k", 1, 10, expected=None)
    assert signals.promote(runs, one, "k", 1, 11, expected=None).count() == 1
    for run, expected in ((2, None), (7, 1)):
        with pytest.raises(ValueError):
            signals.promote(runs, one, "k", run, 11, expected=expected)
    assert [(r.run, r.promoted) for r in signals.registry(runs, signals.promote(runs, one, "k", 2, 11, expected=1)).collect()] == [(2, True), (1, False)]


def test_shapes_report_each_broken_constraint(spark):
    g = Graph(spark)
    g.entities["P"] = spark.createDataFrame([("P/1", "12", 5), ("P/2", "x", 50), ("P/3", None, None)], "id string, code string, n int")
    shapes = [ontology.Shape("P", "code", min_count=1, datatype="int"), ontology.Shape("P", "n", max_value=9, one_of=(5, 7))]
    assert sorted((r.focus, r.constraint) for r in ontology.check_shapes(g, shapes).collect()) == [("P/2", "P.code datatype"), ("P/2", "P.n in"), ("P/2", "P.n maxInclusive"), ("P/3", "P.code minCount")]


def test_signals_and_registry(spark):
    feed = spark.createDataFrame([(1, "view", 7), (2, "purchase", 7), (2, "purchase", 7), (3, "view", 8), (9, "purchase", 8)], "seq long, kind string, user_id long")
    fresh = signals.ingest(feed, feed.where("seq = 1"), ["view"])
    assert sorted((r.seq, r.trainable) for r in fresh.collect()) == [(2, True), (3, False), (9, True)]
    unique = feed.dropDuplicates(["seq"])
    assert sorted((r.seq, r.label) for r in signals.suggestions(unique, "view", "purchase", 5).collect()) == [(1, True), (3, False)]
    assert [(r.chosen, r.rejected) for r in signals.preference_pairs(unique, "purchase", "view", 5).collect()] == [(2, 1)]
    runs = signals.numbered_runs(spark.createDataFrame([("k", i, f"m{i}") for i in range(6)], "kind string, recorded int, manifest string"))
    listed = signals.registry(runs, spark.createDataFrame([("k", 2, 1), ("k", 1, 2)], "kind string, run int, at int"))
    assert sorted(r.run for r in signals.registry_gc(listed, 2).collect()) == [1, 5, 6]
    audit = signals.split_audit(unique.where("seq <= 5"), unique.where("seq > 5"), 5).first()
    assert audit.clean and not signals.split_audit(unique, unique, 5).first().clean
    assert {r.kind: r.due for r in signals.cadence(unique, spark.createDataFrame([("view", 2)], "kind string, signals_at_run int")).collect()} == {"view": False, "purchase": True}


def test_traces_and_anchors(spark):
    trace = signals.planner_trace(spark.createDataFrame([("q1", "t1", 3)], "ask_id string, snapshot_token string, steps int")).first()
    assert (trace.kind, trace.request_id, trace.snapshot_token) == ("external_planner_trace", "q1", "t1")
    turns = spark.createDataFrame([(1, 0, "the cat sat"), (1, 1, "on a mat")], "conv_id long, turn long, text string")
    facts = spark.createDataFrame([(1, "cat sat"), (1, "dog")], "conv_id long, evidence string")
    assert [r.evidence for r in signals.anchored(facts, turns).collect()] == ["cat sat"]
