"""Signals, datasets made from them, feedback, and the registry of model runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegraph.operators import temporal, writes
from tidegraph.operators.ranking import Comparison, may_be_promoted


def signals(events: DataFrame) -> DataFrame:
    """The events table as an append-only feed: seq, kind, payload."""
    return events.select(F.col("event_id").alias("seq"), F.col("event_type").alias("kind"), F.col("props").alias("payload"), "user_id", "ts", "value")


def wrap(rows: DataFrame, kind: str, payload: Sequence[str]) -> DataFrame:
    """Rows as signals of one kind, the payload columns as JSON."""
    return rows.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*payload)).alias("payload"))


def planner_trace(rows: DataFrame) -> DataFrame:
    """ask_id and snapshot_token are lifted out of the payload."""
    trace = wrap(rows, "external_planner_trace", rows.columns)
    return trace.withColumns({"request_id": F.get_json_object("payload", "$.ask_id"), "snapshot_token": F.get_json_object("payload", "$.snapshot_token")})


def read_range(feed: DataFrame, first: int, last: int, most: int | None = None) -> DataFrame:
    """Signals by seq, oldest first."""
    found = feed.where(F.col("seq").between(first, last)).orderBy("seq")
    return found if most is None else found.limit(most)


def ingest(new: DataFrame, known: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Signals that aren't in the feed yet, and whether training may use them."""
    fresh = new.dropDuplicates(["seq"]).join(known.select("seq"), "seq", "left_anti")
    return fresh.withColumn("trainable", ~F.col("kind").isin(list(excluded)))


#: Signals of one bucket of seq, by which a user with very many is dealt over several tasks.
SEQ_BUCKET = 1 << 20


def suggestions(feed: DataFrame, shown: str, adopted: str, split: int | Column) -> DataFrame:
    """Each user's shown signals at or before split, labelled by whether the user adopts next."""
    seen = temporal.next_after(feed.where(F.col("seq") <= split), "user_id", ["seq"], F.col("kind"), "_following", F.floor(F.col("seq") / SEQ_BUCKET))
    return seen.where(F.col("kind") == shown).select("seq", "user_id", F.coalesce(F.col("_following") == adopted, F.lit(False)).alias("label"))


def preference_pairs(feed: DataFrame, good: str, bad: str, split: int | Column) -> DataFrame:
    """Per user, each good signal with the last bad one before it: one ordered pass, not a product of good and bad."""
    rejected = F.when(F.col("kind") == bad, F.col("seq"))
    seen = temporal.last_before(feed.where(F.col("seq") <= split), "user_id", ["seq"], rejected, "rejected", F.floor(F.col("seq") / SEQ_BUCKET))
    return seen.where((F.col("kind") == good) & F.col("rejected").isNotNull()).select("user_id", F.col("seq").alias("chosen"), "rejected")


def extractor_examples(episodes: DataFrame) -> DataFrame:
    """Conversation turns as (input, target) pairs: a user's turn and the assistant's next."""
    order = W.partitionBy("conv_id").orderBy("turn")
    rows = episodes.withColumns({"_next": F.lead("text").over(order), "_role": F.lead("role").over(order)})
    return rows.where("role = 'user' AND _role = 'assistant'").select("conv_id", "turn", F.col("text").alias("input"), F.col("_next").alias("target"))


def episodes(turns: DataFrame) -> DataFrame:
    """Conversations with their turns in order, kept verbatim."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(F.count("*").alias("turns"), ordered.alias("_t")).select(
        F.concat(F.lit("EPISODE/"), F.col("conv_id").cast("string")).alias("id"), "turns", F.sha2(F.array_join(F.transform("_t", lambda t: F.concat(t["role"], F.lit(": "), t["text"])), "\n"), 256).alias("text_sha256")
    )


def anchored(facts: DataFrame, turns: DataFrame) -> DataFrame:
    """Facts whose evidence occurs in their episode's text; the others are gated out."""
    text = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), "\n").alias("_text"))
    return facts.join(text, "conv_id").where(F.instr("_text", F.col("evidence")) > 0).drop("_text")


@dataclass(frozen=True)
class Observation:
    """What an observation did: the branch's events, facts without their evidence in the text, events that break the ontology, the log afterwards, whether it was merged."""

    branch: DataFrame
    unanchored: DataFrame
    broken: DataFrame
    log: DataFrame
    merged: bool


def observe(log: DataFrame, facts: DataFrame, turns: DataFrame, rules: DataFrame, *, auto_merge: bool = True) -> Observation:
    """Facts (conv_id, evidence, and the log's columns but commit_seq, event_ord and op) of an episode, on a branch of the log.

    Facts whose evidence the episode's text does not hold are left out. The
    rest are one commit on a branch that forks at the log's head; if none of
    them breaks the ontology's rules and auto_merge says so, it is merged.
    """
    head = log.agg(F.max("commit_seq")).first()[0] or 0
    kept = anchored(facts, turns)
    unanchored = facts.join(kept.select("conv_id", "evidence").distinct(), ["conv_id", "evidence"], "left_anti")
    own = kept.withColumns({"commit_seq": F.lit(head + 1).cast("long"), "event_ord": F.lit(0), "op": F.lit("assert")}).select(*log.columns)
    broken = writes.violations(own, rules)
    merged = auto_merge and broken.isEmpty()
    return Observation(own, unanchored, broken, writes.merge(log, own, head, head + 1) if merged else log, merged)


def grades(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """qrels: 3 good, 1 partial, 0 bad."""
    grade = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 3).when(F.col("quality") == 1, 1).otherwise(0)
    return labels.join(documents.select("doc_id", "source"), "doc_id").select(F.col("source").alias("query"), F.concat(F.lit("DOCUMENT/"), F.col("doc_id").cast("string")).alias("target"), grade.alias("grade"))


def feedback_summary(feedback: DataFrame, *, by: Sequence[str] = ("grade",)) -> DataFrame:
    """Raw and deduplicated events by grade, or by grade and split where feedback has one."""
    return feedback.groupBy(*by).agg(F.count("*").alias("raw"), F.countDistinct("query", "target").alias("deduplicated"))


def planner_examples(feed: DataFrame, kind: str, split: int | Column) -> DataFrame:
    """What a planner learns from: traces of one kind at or before split that have a payload, each with its request."""
    found = feed.where((F.col("kind") == kind) & (F.col("seq") <= split) & F.col("payload").isNotNull())
    request = F.col("request_id") if "request_id" in feed.columns else F.col("seq").cast("string")
    return found.select("seq", request.alias("request_id"), "payload")


def numbered_runs(manifests: DataFrame) -> DataFrame:
    """Runs numbered within their kind in the order they were recorded."""
    return manifests.withColumn("run", F.row_number().over(W.partitionBy("kind").orderBy("recorded", "manifest")))


def registry(runs: DataFrame, promotions: DataFrame) -> DataFrame:
    """Runs with the effective promotion, the last one of each kind; newest first."""
    current = promotions.groupBy("kind").agg(F.max(F.struct("at", "run")).alias("_c")).select("kind", F.col("_c.run").alias("current"))
    return runs.join(current, "kind", "left").withColumn("promoted", F.coalesce(F.col("run") == F.col("current"), F.lit(False))).drop("current").orderBy("kind", F.desc("run"))


def promote(runs: DataFrame, promotions: DataFrame, kind: str, run: int, at: int, *, expected: int | None, comparisons: Sequence[Comparison] | None = None) -> DataFrame:
    """The promotions with one more, if the run exists and expected is what is current now; a replay adds nothing.

    With comparisons, a run that is not better in each by its whole interval raises.
    """
    if comparisons is not None and not may_be_promoted(comparisons):
        raise ValueError(f"{kind}'s run {run} is not better in every comparison")
    current = registry(runs, promotions).where((F.col("kind") == kind) & F.col("promoted")).select("run").first()
    if current and current.run == run:
        return promotions
    if (current.run if current else None) != expected:
        raise ValueError(f"{kind} has run {current.run if current else None} promoted, not {expected}")
    if runs.where((F.col("kind") == kind) & (F.col("run") == run)).isEmpty():
        raise ValueError(f"{kind} has no run {run}")
    return promotions.unionByName(promotions.sparkSession.createDataFrame([(kind, run, at)], "kind string, run int, at long").select(*(F.col(c).cast(promotions.schema[c].dataType) for c in ("kind", "run", "at"))).select(*promotions.columns))


def fact_scores(predicted: DataFrame, truth: DataFrame, on: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of predicted facts, over all or by columns that facts have; equal facts count once."""
    one, other = predicted.select(*by, *on).distinct().withColumn("_p", F.lit(1)), truth.select(*by, *on).distinct().withColumn("_t", F.lit(1))
    both = one.join(other, [*by, *on], "full").groupBy(*by).agg(F.count("_p").alias("predicted"), F.count("_t").alias("true"), F.count_if(F.col("_p").isNotNull() & F.col("_t").isNotNull()).alias("hits"))
    both = both.withColumns({"precision": F.try_divide("hits", "predicted"), "recall": F.try_divide("hits", "true")})
    return both.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("hits"), F.col("predicted") + F.col("true")), F.lit(0.0)))


def slot_exactness(predicted: DataFrame, truth: DataFrame, key: str, slots: Sequence[str]) -> DataFrame:
    """How many requests have all slots right, null being right only for null; a request without a prediction is wrong."""
    own = predicted.select(key, F.struct(*slots).alias("_p"))
    right = reduce(lambda a, b: a & b, (F.col(f"_p.{s}").eqNullSafe(F.col(s)) for s in slots)) & F.col("_p").isNotNull()
    return truth.join(own, key, "left").agg(F.count("*").alias("requests"), F.count_if(right).alias("exact"), F.try_divide(F.count_if(right), F.count("*")).alias("exactness"))


@dataclass(frozen=True)
class Tick:
    """What a training tick did: its best candidate, that one's score on the training slice and held out, and whether it is promoted."""

    candidate: str
    train_score: float
    held_score: float
    champion_score: float
    promoted: bool


def train_tick(feed: DataFrame, candidates: dict[str, Callable[[DataFrame], DataFrame]], metric: Callable[[DataFrame], float], split: int, *, champion: Callable[[DataFrame], DataFrame], margin: float = 0.0, most: int = 32) -> Tick:
    """A bounded search on signals at or before split, gated on those after it.

    Each candidate maps signals to predictions, which metric scores by a Spark
    job; the best on the training slice (ties: the first by name) is promoted
    if it beats the champion by over margin on the held-out signals.
    """
    if not 1 <= len(candidates) <= most:
        raise ValueError(f"from 1 to {most} candidates")
    train, held = feed.where(F.col("seq") <= split), feed.where(F.col("seq") > split)
    scores = {name: metric(predict(train)) for name, predict in sorted(candidates.items())}
    best = max(scores, key=lambda n: scores[n])
    reached, now = metric(candidates[best](held)), metric(champion(held))
    return Tick(best, scores[best], reached, now, reached > now + margin)


def registry_gc(listed: DataFrame, keep: int) -> DataFrame:
    """What stays: promoted runs and the last keep of each kind."""
    place = F.row_number().over(W.partitionBy("kind").orderBy(F.col("run").desc()))
    return listed.withColumn("_place", place).where((F.col("_place") <= keep) | F.col("promoted")).drop("_place")


def split_audit(train: DataFrame, held: DataFrame, split: int | Column) -> DataFrame:
    """Whether training stays at or before the split and evaluation after it."""
    one = train.agg(F.max("seq").alias("train_max"), F.count("*").alias("train_rows"))
    other = held.agg(F.min("seq").alias("eval_min"), F.count("*").alias("eval_rows"))
    split = F.lit(split)
    return one.crossJoin(other).withColumn("clean", F.coalesce(F.col("train_max") <= split, F.lit(True)) & F.coalesce(F.col("eval_min") > split, F.lit(True)))


def cadence(feed: DataFrame, trained: DataFrame) -> DataFrame:
    """A kind is due once it has twice the signals of its last run."""
    now = feed.groupBy("kind").agg(F.count("*").alias("signals"))
    return now.join(trained, "kind", "left").withColumn("due", F.coalesce(F.col("signals") >= 2 * F.col("signals_at_run"), F.lit(True)))


def probes(edges: DataFrame, most: int) -> DataFrame:
    """Questions with executed answers: what src leads to by relation, for the first most by a hash, the same on every run.

    answers comes from the edges as they are; verified says that asking for
    each answer by itself finds as many.
    """
    asked = edges.select("src", "relation").distinct().withColumn("_order", F.md5(F.concat("src", F.lit("|"), "relation").cast("binary"))).orderBy("_order").limit(most).drop("_order")
    answers = edges.select("src", "relation", "dst").join(asked, ["src", "relation"], "left_semi").distinct()
    found = answers.groupBy("src", "relation").agg(F.count("*").alias("answers"), F.min("dst").alias("first_answer"))
    again = edges.join(answers, ["src", "relation", "dst"], "left_semi").groupBy("src", "relation").agg(F.countDistinct("dst").alias("_again"))
    return found.join(again, ["src", "relation"]).withColumn("verified", F.col("answers") == F.col("_again")).drop("_again")


#: The most queries of one comparison of rankings.
QUERIES = 1000


def retrieval(vectors: DataFrame, queries: DataFrame, dims: int, most: int = 10) -> DataFrame:
    """(query_id, hits): how many of each query's most nearest vectors, itself left out, have its label.

    queries is a list that a request gives, at most QUERIES of them, which is
    checked, and so small enough to go to every task; each task ranks its own
    vectors, and a group limit lets only the nearest of each task travel.
    """
    if queries.limit(QUERIES + 1).count() > QUERIES:
        raise ValueError(f"over {QUERIES} queries")
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("label").alias("query_label"), F.slice("embedding", 1, dims).alias("_q"))
    dot = F.aggregate(F.zip_with(F.slice("embedding", 1, dims), "_q", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    scored = vectors.join(F.broadcast(asked), F.col("vec_id") != F.col("query_id")).select("query_id", "query_label", "vec_id", "label", F.round(dot, 6).alias("score"))
    ranked = scored.withColumn("_rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("_rank") <= most)
    return ranked.groupBy("query_id").agg(F.count_if(F.col("label") == F.col("query_label")).alias("hits"))
