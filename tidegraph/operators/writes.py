"""What writes do to the event log, as DataFrames of events.

A commit appends rows; nothing is changed in place. Each function gives the
events to append or a report, and the caller decides where Parquet is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from tidegraph.operators.temporal import last_events
from tidegraph.shared import folders, materialise

EVENT_COLUMNS = ["edge_id", "src", "relation", "dst", "commit_seq", "valid_from", "op", "event_ord", "quantity"]


def append(events: DataFrame, path: str) -> None:
    """Appends to the log, a folder for each relation."""
    events.write.mode("append").option("compression", "zstd").partitionBy("relation").parquet(path)


@dataclass(frozen=True)
class Ack:
    """What a commit reports: its sequence, operations appended, edges left out as unchanged, whether nothing was to be done, whether all was there."""

    commit_seq: int
    op_count: int
    skipped_edges: int
    no_op: bool
    idempotent_replay: bool


#: What names an event: an edge may have several in one commit, in an order.
EVENT_KEY = ("edge_id", "commit_seq", "event_ord")


def commit(events: DataFrame, log: DataFrame, path: str, *, key: Sequence[str] = EVENT_KEY, skip_unchanged: bool = False) -> Ack:
    """Appends the events that the log lacks to path, and says what was done.

    With skip_unchanged, assertions of edges that the log's state has with the
    same content are left out. A key is bound to its content: one that comes
    with another than the log's, or with two contents at once, raises.
    """
    found = _weighed(events, log, key)
    # digests only tell where to look: what they hold apart may still be equal
    if found["doubtful"] and not conflicts(events, log, key).isEmpty():
        raise ValueError("a key comes with more than one content")
    given, lacking = found["given"], found["lacking"]
    head, appended = log.agg(F.max("commit_seq")).first()[0] or 0, 0
    if lacking:
        # where all is new and nothing comes twice, there is nothing to compare
        fresh = events if found["sent"] == lacking else new_events(events, log, key)
        wanted = skip_current(fresh, log) if skip_unchanged else fresh
        # counted while it is written; files that this adds are none of log's, which may be read from path
        seen = Observation()
        append(wanted.observe(seen, F.count(F.lit(1)).alias("n"), F.max("commit_seq").alias("head")), path)
        appended, head = seen.get["n"], max(head, seen.get["head"] or 0)
    return Ack(head, appended, lacking - appended, appended == 0, given > 0 and lacking == 0)


def _digest(columns: Sequence[str | Column]) -> list[Column]:
    """Two numbers of 64 bits that tell contents apart, nulls included."""
    # Spark's own format leaves microseconds out
    at = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    told = F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "timestampFormat": f"{at}XXX", "timestampNTZFormat": at})
    return [F.xxhash64(told), F.xxhash64(F.lit("second"), told)]


def _weighed(events: DataFrame, log: DataFrame, key: Sequence[str]) -> dict[str, int]:
    """How many rows are sent, how many keys these give and the log lacks, and how many keys have digests of more than one content.

    Told by groups of keys where these show it, else by each key.
    """
    return _weighed_by_group(events, log, key) or _weighed_by_key(events, log, key)


#: Places of a group's keys that can be told apart.
PLACES = 32


def _weighed_by_group(events: DataFrame, log: DataFrame, key: Sequence[str]) -> dict[str, int] | None:
    """What _weighed() says if each group of keys that differ in the last column only is wholly new or wholly what the log has; else None.

    A group is a few numbers, combined before the shuffle. That no key comes
    twice is shown by as many places as rows, and equal sets of rows by digests
    that cancel out. Groups that meet by their hash can hide this, not feign it.
    """
    content = [c for c in events.columns if c not in key]
    alike = [F.col(c).cast(events.schema[c].dataType).alias(c) for c in key]
    whole = isinstance(events.schema[key[-1]].dataType, TY.IntegralType)
    place = F.pmod(F.coalesce(F.col(key[-1]).cast("long") if whole else F.xxhash64(key[-1]), F.lit(0).cast("long")), F.lit(PLACES)).cast("int")

    def told(rows: DataFrame, keys: Sequence[str | Column], sent: bool) -> DataFrame:
        one, two = _digest([*keys, *content])
        group = _digest(keys[:-1])[0] if len(keys) > 1 else _digest(keys)[0]
        return rows.select(group.alias("_g"), place.alias("_place"), one.alias("_one"), two.alias("_two"), F.lit(sent).alias("_sent"))

    known = log.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key)))
    both = told(events, list(key), True).unionByName(told(known, alike, False))
    bit = F.expr(f"shiftleft(1L, IF(_sent, _place, _place + {PLACES}))")
    each = both.groupBy("_g").agg(F.count_if("_sent").alias("_n"), F.count_if(~F.col("_sent")).alias("_known"), F.bit_or(bit).alias("_bits"), F.bit_xor("_one").alias("_one"), F.bit_xor("_two").alias("_two")).where("_n > 0")
    apart = F.bit_count("_bits") == F.col("_n") + F.col("_known")
    same = (F.col("_n") == F.col("_known")) & (F.col("_one") == 0) & (F.col("_two") == 0)
    clear = apart & ((F.col("_known") == 0) | same)
    sums = each.agg(F.sum("_n").alias("sent"), F.sum(F.when(F.col("_known") == 0, F.col("_n")).otherwise(0)).alias("lacking"), F.count_if(~clear).alias("_unclear")).first()
    if sums["_unclear"]:
        return None
    sent = sums["sent"] or 0
    return {"sent": sent, "given": sent, "lacking": sums["lacking"] or 0, "doubtful": 0}


def _weighed_by_key(events: DataFrame, log: DataFrame, key: Sequence[str]) -> dict[str, int]:
    """What _weighed() says, by one shuffle of four numbers for each row of both; no content travels."""
    content = [c for c in events.columns if c not in key]
    alike = [F.col(c).cast(events.schema[c].dataType).alias(c) for c in key]

    def told(rows: DataFrame, keys: Sequence[str | Column], sent: bool) -> DataFrame:
        numbers = zip(("_k", "_l", "_c", "_d"), _digest(keys) + _digest(content), strict=True)
        return rows.select(*(n.alias(name) for name, n in numbers), F.lit(sent).alias("_sent"))

    # a null in a key is equal to none of the log's
    known = log.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key)))
    both = told(events, key, True).unionByName(told(known, alike, False)).repartition("_k", "_l")
    ends = [f(c).alias(f"_{n}{c}") for c in ("_c", "_d") for n, f in (("least", F.min), ("most", F.max))]
    each = both.groupBy("_k", "_l").agg(F.count_if("_sent").alias("_n"), F.count_if(~F.col("_sent")).alias("_known"), *ends).where("_n > 0")
    doubtful = (F.col("_least_c") != F.col("_most_c")) | (F.col("_least_d") != F.col("_most_d"))
    sums = each.agg(F.sum("_n").alias("sent"), F.count("*").alias("given"), F.count_if(F.col("_known") == 0).alias("lacking"), F.count_if(doubtful).alias("doubtful"))
    return {k: v or 0 for k, v in sums.first().asDict().items()}


def retract(state: DataFrame, edges: DataFrame, commit_seq: int | Column) -> DataFrame:
    """Retractions of the state's edges that edges names by edge_id."""
    found = state.join(edges.select("edge_id").distinct(), "edge_id", "left_semi")
    return found.withColumns({"op": F.lit("retract"), "event_ord": F.lit(0), "commit_seq": F.lit(commit_seq).cast("long")}).select(*state.columns)


def retract_entities(state: DataFrame, ids: DataFrame, commit_seq: int | Column) -> DataFrame:
    """Retractions of every edge that touches an entity of ids (id): two semi-joins, since OR would not be an equi-join."""
    by = lambda end: state.join(ids.select(F.col("id").alias(end)).distinct(), end, "left_semi").select("edge_id")
    return retract(state, by("src").unionByName(by("dst")), commit_seq)


def _same(columns: Sequence[str], one: str, other: str) -> Column:
    """Column by column, null being equal to null only."""
    return reduce(lambda a, b: a & b, (F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in columns), F.lit(True))


def diff(current: DataFrame, payload: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, change): added, changed, removed or unchanged, by one full outer join on the key."""
    old = current.select(F.col(key), F.struct(*columns).alias("_old"))
    new = payload.select(F.col(key), F.struct(*columns).alias("_new"))
    return old.join(new, key, "full").select(key, _change(columns).alias("change"))


def _change(columns: Sequence[str]) -> Column:
    """What happened to a row from _old to _new."""
    return F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(~_same(columns, "_old", "_new"), "changed").otherwise("unchanged")


@dataclass(frozen=True)
class Reload:
    """The events of a cutover, how many edges it changes, and the commit to go back to."""

    events: DataFrame
    counts: dict[str, int]
    prior_commit_seq: int


def reload(log: DataFrame, payload: DataFrame, columns: Sequence[str], *, graph_id: str, confirm: str | None = None, dry_run: bool = False, observed_at: object = None) -> Reload:
    """The one commit after which the state equals payload: what is there is asserted, what is absent is retracted.

    payload has the log's columns but for commit_seq, event_ord and op; columns
    are those whose change counts. confirm must be graph_id unless it is a dry
    run, which gives no events. Reading at prior_commit_seq gives the state
    before. A second reload of the same payload has no events.
    """
    if not dry_run and confirm != graph_id:
        raise ValueError(f"confirm must be {graph_id}")
    prior = log.agg(F.max("commit_seq")).first()[0] or 0
    state = last_events(log).where("op = 'assert'")
    own = [c for c in log.columns if c != "edge_id"]
    sent = [c for c in payload.columns if c != "edge_id"]
    old = state.select("edge_id", F.struct(*own).alias("_old"))
    met = old.join(payload.select("edge_id", F.struct(*sent).alias("_new")), "edge_id", "full").withColumn("change", _change(columns))
    # one fold and one join, written once with the rows that change; counts and both kinds of events read it
    kept = {"_old": F.when(F.col("change") == "removed", F.col("_old")), "_new": F.when(F.col("change").isin("added", "changed"), F.col("_new"))}
    met = materialise(met.withColumns(kept), "diff")
    counts = {"added": 0, "changed": 0, "removed": 0, "unchanged": 0} | {r.change: r.n for r in met.groupBy("change").agg(F.count("*").alias("n")).collect()}
    marks = {"commit_seq": F.lit(prior + 1).cast("long"), "event_ord": F.lit(0)}
    upserts = met.where("change IN ('added', 'changed')").select("edge_id", *(F.col(f"_new.{c}").alias(c) for c in sent)).withColumns(marks | {"op": F.lit("assert")})
    if observed_at is not None and "valid_from" in log.columns:
        upserts = upserts.withColumn("valid_from", F.lit(observed_at).cast("timestamp_ntz"))
    gone = met.where("change = 'removed'").select("edge_id", *(F.col(f"_old.{c}").alias(c) for c in own)).withColumns(marks | {"op": F.lit("retract")})
    events = upserts.select(*log.columns).unionByName(gone.select(*log.columns))
    return Reload(events.limit(0) if dry_run else events, counts, prior)


def branch(trunk: DataFrame, own: DataFrame, fork_seq: int | Column) -> DataFrame:
    """A branch reads its parent up to the fork and its own commits; nothing is copied."""
    return trunk.where(F.col("commit_seq") <= fork_seq).unionByName(own)


def merge(trunk: DataFrame, own: DataFrame, fork_seq: int | Column, commit_seq: int | Column, *, rules: DataFrame | None = None) -> DataFrame:
    """The branch's commits since the fork as one commit on a parent that stood still: the last event of each edge.

    With rules, edges that the ontology does not allow raise before anything
    is merged. A parent that went on needs merge_three_way().
    """
    replayed = last_events(own.where(F.col("commit_seq") > fork_seq))
    if isinstance(commit_seq, int) and (trunk.agg(F.max("commit_seq")).first()[0] or 0) >= commit_seq:
        raise ValueError(f"the parent's head is at commit {commit_seq} or later")
    if rules is not None and not violations(replayed, rules).isEmpty():
        raise ValueError("the branch has edges that the ontology does not allow")
    return trunk.unionByName(replayed.withColumns({"commit_seq": F.lit(commit_seq).cast("long"), "event_ord": F.lit(0)}).select(*trunk.columns))


@dataclass(frozen=True)
class Merge:
    """The one commit that a merge adds to the parent, how many edges were changed how, and the edges in conflict with what base, parent and branch say of them (null: no such edge)."""

    events: DataFrame
    counts: dict[str, int]
    conflicts: DataFrame


def merge_three_way(trunk: DataFrame, own: DataFrame, fork_seq: int, *, rules: DataFrame | None = None, prefer: str | None = None) -> Merge:
    """Merges a branch into a parent that may have gone on since the fork.

    Per edge, the states at the fork, of the parent and of the branch are held
    against one another, all from one aggregation of both logs. What only the
    branch changed is clean and goes in; what both changed alike is equal and
    needs nothing; what both changed differently is a conflict, and stays as
    the parent has it unless prefer is branch. The commit is the parent's
    head + 1. With rules, edges that they do not allow, and sources with more
    edges of a relation in the merged state than max_count, raise. Content is
    all columns but commit_seq, event_ord and op.
    """
    if prefer not in (None, "parent", "branch"):
        raise ValueError(f"no side {prefer}")
    others = [c for c in trunk.columns if c not in ("edge_id", "commit_seq", "event_ord")]
    row = F.struct("commit_seq", "event_ord", *others)
    both = trunk.withColumn("_own", F.lit(False)).unionByName(own.where(F.col("commit_seq") > fork_seq).withColumn("_own", F.lit(True)))
    at_fork = F.col("commit_seq") <= fork_seq
    last = both.groupBy("edge_id").agg(
        F.max(F.when(~F.col("_own") & at_fork, row)).alias("_b"), F.max(F.when(~F.col("_own"), row)).alias("_p"), F.max(F.when(F.col("_own") | at_fork, row)).alias("_o")
    )
    contents = [c for c in others if c != "op"]
    told = lambda e: F.when(F.col(f"{e}.op") == "assert", F.struct(*(F.col(f"{e}.{c}").alias(c) for c in contents)))
    sides = last.select("edge_id", "_o", told("_b").alias("base"), told("_p").alias("parent"), told("_o").alias("branch"))
    moved = lambda side: ~F.col(side).eqNullSafe(F.col("base"))
    change = F.when(~moved("branch"), F.when(moved("parent"), "parent only").otherwise("unchanged")).when(~moved("parent"), "clean").when(F.col("branch").eqNullSafe(F.col("parent")), "equal").otherwise("conflict")
    # written once; counts, conflicts, checks and events all read it
    sides = materialise(sides.withColumn("change", change).where("change <> 'unchanged'"), "merge")
    counts = {"clean": 0, "equal": 0, "conflict": 0, "parent only": 0} | {r["change"]: r["n"] for r in sides.groupBy("change").agg(F.count("*").alias("n")).collect()}
    head = trunk.agg(F.max("commit_seq")).first()[0] or 0
    wanted = sides.where(F.col("change").isin(["clean", "conflict"] if prefer == "branch" else ["clean"]))
    marks = {"commit_seq": F.lit(head + 1).cast("long"), "event_ord": F.lit(0).cast(trunk.schema["event_ord"].dataType)}
    # an edge that the branch lacks is retracted, with what its last event said
    events = wanted.select("edge_id", *(F.col(f"_o.{c}").alias(c) for c in others)).withColumns(marks | {"op": F.when(F.col("op") == "assert", "assert").otherwise("retract")}).select(*trunk.columns)
    if rules is not None:
        if not violations(events, rules).isEmpty():
            raise ValueError("the branch has edges that the ontology does not allow")
        if not _too_many(trunk, events, rules).isEmpty():
            raise ValueError("after the merge a source has more edges of a relation than the ontology allows")
    return Merge(events, counts, sides.where("change = 'conflict'").select("edge_id", "base", "parent", "branch"))


def _too_many(log: DataFrame, events: DataFrame, rules: DataFrame) -> DataFrame:
    """Sources that the events touch which have too many edges of a relation then."""
    if "max_count" not in rules.columns:
        return events.limit(0)
    limits = rules.groupBy("relation").agg(F.max("max_count").alias("max_count")).where("max_count IS NOT NULL")
    touched = events.select("src", "relation").distinct()
    near = log.join(touched, ["src", "relation"], "left_semi").select(*events.columns).unionByName(events)
    found = last_events(near).where("op = 'assert'").groupBy("src", "relation").agg(F.count("*").alias("n"))
    return found.join(limits, "relation").where("n > max_count")


def compact(events: DataFrame, *, horizon: int | None = None) -> DataFrame:
    """The log in the order of its edges, to be written to few files that prune well.

    Every event stays, so each read at an earlier commit or time and every
    history is what it was. With a horizon, of the commits up to there only
    each edge's last event stays: reads at the horizon or later are what they
    were, earlier ones are given up.
    """
    if horizon is not None:
        old = last_events(events.where(F.col("commit_seq") <= horizon)).select(*events.columns)
        events = old.unionByName(events.where(F.col("commit_seq") > horizon))
    return events.repartitionByRange("edge_id").sortWithinPartitions("edge_id", "commit_seq", "event_ord")


def new_events(events: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replay-safe appending: what the log has under the key is left out, and of equal rows one stays."""
    return events.join(known.select(*key).distinct(), list(key), "left_anti").distinct()


def conflicts(events: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Events whose key the log has with other content, or the events themselves with two contents."""
    content = [c for c in events.columns if c not in key]
    sent = events.select(*key, F.struct(*content).alias("_new"))
    old = known.select(*key, F.struct(*content).alias("_old"))
    against = sent.join(old, list(key)).where(~_same(content, "_new", "_old"))
    twice = sent.groupBy(*key).agg(F.min("_new").alias("_one"), F.max("_new").alias("_new")).where(~_same(content, "_new", "_one"))
    return against.unionByName(twice, allowMissingColumns=True).select(*key, "_new.*")


def skip_current(events: DataFrame, log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Events without those of edges that they leave as the state has them.

    Such an edge's events are all assertions of the one content that the state
    has in the columns, without the argument in all but commit_seq, event_ord
    and op. Where an edge is retracted too, or gets several contents, every
    event counts and stays. The events that one edge has in events meet in one
    task, which spills them.
    """
    columns = [c for c in columns or events.columns if c in events.columns and c not in ("edge_id", "commit_seq", "event_ord", "op")]
    now = last_events(log).where("op = 'assert'").select("edge_id", F.struct(*columns).alias("_old"))
    own = events.select("*", F.struct(*columns).alias("_new"))
    # told after the join: equal columns in its condition would be keys, and move both sides again
    moves = (F.col("op") != "assert") | F.col("_old").isNull() | ~_same(columns, "_new", "_old")
    met = own.join(now, "edge_id", "left").withColumn("_moves", F.coalesce(moves, F.lit(True)))
    # each event travels once; of an edge, all stay or none
    stays = F.max("_moves").over(W.partitionBy("edge_id"))
    return met.withColumn("_stays", stays).where("_stays").select(*events.columns)


# ------------------------------------------------------------------ commits that are bound to a key


class KeyReused(ValueError):
    """A commit's key came again with other content."""


def digests(events: DataFrame, key: str | None = None) -> DataFrame:
    """(key, op_count, digest) of commits' events, in whatever order and partitions they come; repeated events count each.

    Each event's SHA-256 is four numbers of 64 bits, and a commit's digest is
    their sums; so it is one aggregation that combines before the shuffle.
    """
    columns = sorted(c for c in events.columns if c != key)
    told = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    number = lambda i: F.conv(F.substring("_d", 1 + 16 * i, 16), 16, 10).cast("decimal(38,0)")
    rows = events.select(*([key] if key else []), told.alias("_d"))
    sums = [(F.sum(number(i)) % F.lit(str(1 << 64)).cast("decimal(38,0)")).cast("string") for i in range(4)]
    grouped = rows.groupBy(key) if key else rows.groupBy()
    return grouped.agg(F.count("*").alias("op_count"), F.coalesce(F.concat_ws(":", *sums), F.lit("")).alias("digest"))


def judge(sent: DataFrame, ledger: DataFrame, key: str = "commit_key") -> DataFrame:
    """digests() of commits with a verdict each: new, replay (the ledger has the key with this content) or conflict (with another)."""
    known = ledger.select(key, F.col("digest").alias("_digest"), F.col("op_count").alias("_count"))
    same = F.col("digest").eqNullSafe(F.col("_digest")) & (F.col("op_count") == F.col("_count"))
    return sent.join(known, key, "left").withColumn("verdict", F.when(F.col("_count").isNull(), "new").when(same, "replay").otherwise("conflict")).drop("_digest", "_count")


LEDGER = "commit_key string, commit_seq long, op_count long, digest string"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The commits under path, a row each."""
    names = folders(spark, f"{path}/ledger")
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/*") if names else spark.createDataFrame([], LEDGER)


def committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The events of all commits under path."""
    known = sorted(r["commit_seq"] for r in ledger(spark, path).select("commit_seq").collect())
    paths = [f"{path}/events/commit={n}" for n in known]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def commit_once(events: DataFrame, path: str, commit_key: str) -> Ack:
    """Adds events (without commit_seq) as the next commit, once for each key.

    The key is looked up in a ledger of a row for each commit, by content: the
    same again is a replay and adds nothing, another raises KeyReused. The log
    itself is not read. A commit's events are a folder that its ledger row,
    written last, makes part of the log; what a failed commit left behind is
    replaced by the next one. One writer at a time: the second of two that
    meet fails on the ledger row.
    """
    spark = events.sparkSession
    known, own = ledger(spark, path), digests(events).first()
    before = known.where(F.col("commit_key") == commit_key).first()
    if before is not None:
        if (before["digest"], before["op_count"]) != (own["digest"], own["op_count"]):
            raise KeyReused(f"key {commit_key} is that of commit {before['commit_seq']}, which has other content")
        return Ack(before["commit_seq"], 0, 0, True, True)
    seq = (known.agg(F.max("commit_seq")).first()[0] or 0) + 1
    events.withColumn("commit_seq", F.lit(seq).cast("long")).write.mode("overwrite").parquet(f"{path}/events/commit={seq}")
    row = [(commit_key, seq, own["op_count"], own["digest"])]
    spark.createDataFrame(row, LEDGER).coalesce(1).write.mode("errorifexists").parquet(f"{path}/ledger/commit={seq}")
    return Ack(seq, own["op_count"], 0, own["op_count"] == 0, False)


def _kind(end: str) -> Column:
    return F.split(end, "/", 2)[0]


def _with_rules(events: DataFrame, relations: DataFrame) -> DataFrame:
    """Each event once, with the domains and ranges of its relation: a row of rules for a relation, however many it allows."""
    rules = relations.groupBy("relation").agg(F.collect_set("domain").alias("_domains"), F.collect_set("range").alias("_ranges"))
    wrong = F.col("_domains").isNull() | ~F.array_contains("_domains", _kind("src")) | ~F.array_contains("_ranges", _kind("dst"))
    return events.join(rules, "relation", "left").withColumn("_wrong", F.coalesce(wrong, F.lit(True)))


def violations(events: DataFrame, relations: DataFrame) -> DataFrame:
    """Events whose relation or ends the ontology (relation, domain, range) does not know."""
    return _with_rules(events, relations).where("_wrong").select(*events.columns)


def dry_run(events: DataFrame, relations: DataFrame) -> DataFrame:
    """What a commit would do: operations, distinct edges, and events whose relation or ends the ontology doesn't know."""
    checked = _with_rules(events, relations)
    return checked.agg(F.count("*").alias("op_count"), F.countDistinct("edge_id").alias("edges"), F.count_if("_wrong").alias("violations"))
