import random

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import ontology


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_resolution_equals_all_pairs(spark, most):
    dice = random.Random(most)
    word = lambda: "".join(dice.choice("abc") for _ in range(dice.randrange(0, 12)))
    names = {f"N/{i:02}": word() for i in range(40)} | {"N/98": "a", "N/99": "ab"}
    mentions = {word() for _ in range(60)}
    for name in list(names.values())[:25]:
        text = list(name)
        for _ in range(dice.randrange(most + 1)):
            at = dice.randrange(len(text) + 1)
            text[at : at + dice.randrange(2)] = dice.choice(["", "c", "a"])
        mentions.add("".join(text))
    rows = spark.createDataFrame(sorted(names.items()), "id string, name string")
    got = {r.mention: (r.distance, r.id) for r in ontology.resolve(spark.createDataFrame([(m,) for m in mentions], "mention string"), rows, most).collect()}
    near = {m: min((distance(m, n), i) for i, n in names.items()) for m in mentions}
    assert got == {m: best for m, best in near.items() if best[0] <= most}


def test_rows_for_a_name_do_not_grow_with_its_length(spark):
    sizes = spark.createDataFrame([("x" * n,) for n in (0, 1, 5, 50, 500)], "t string").select(F.size(ontology._own_pieces(F.col("t"), 2)).alias("own"), F.size(ontology._looked_up(F.col("t"), 2)).alias("asked")).collect()
    assert [r.own for r in sizes] == [3] * 5 and max(r.asked for r in sizes) <= 75


def test_search_ranks_by_what_few_names_have(spark):
    names = spark.createDataFrame([("N/1", "New Zealand"), ("N/2", "New Caledonia"), ("N/3", "New Guinea"), ("N/4", "Zeeland"), ("N/5", "")], "id string, name string")
    texts = spark.createDataFrame([("new zealnd",), ("NEW",), ("qqq",), ("",), (None,)], "text string")
    found = ontology.ranked_search(texts, ontology.name_index(names), most=3).collect()
    of = lambda t: [r.id for r in sorted(found, key=lambda r: r.rank) if r.text == t]
    assert of("new zealnd")[0] == "N/1" and of("new zealnd")[1] in ("N/2", "N/3", "N/4")
    assert set(of("NEW")) == {"N/1", "N/2", "N/3"} and of("qqq") == [] == of(None)
    assert ontology.ranked_search(texts, ontology.name_index(names.limit(0))).count() == 0


def test_copies_of_names_are_met_once_and_ranked_by_id(spark):
    rows = [(f"n{i:03}", "Ada Byron") for i in range(100)] + [("a", "Ada"), ("z", "Ada")]
    index = ontology.name_index(spark.createDataFrame(rows, "id string, name string"))
    alike = [tuple(r) for r in ontology._of_equal_runs(index, 3).orderBy("_first", "id").collect()]
    assert alike == [("a", "a"), ("a", "z"), ("n000", "n000"), ("n000", "n001"), ("n000", "n002")]
    found = ontology.ranked_search(spark.createDataFrame([("ada",), ("byron",)], "text string"), index, most=3)
    assert [(r.text, r.id, r["rank"]) for r in found.orderBy("text", "rank").collect()] == [("ada", "a", 1), ("ada", "z", 2), ("ada", "n000", 3), ("byron", "n000", 1), ("byron", "n001", 2), ("byron", "n002", 3)]


def test_no_run_of_a_name_is_broadcast(spark):
    names = spark.createDataFrame([(f"n{i:03}", f"Ada Byron {i}") for i in range(50)], "id string, name string")
    texts = spark.createDataFrame([("ada",)], "text string")
    index = ontology.name_index(names)
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (index, ontology.ranked_search(texts, index, most=3))]
    # but for what letters there are, the number of names and the texts' own
    assert all("Join" not in line or "broadcast" in line or "merge" in line or "Cross" in line for plan in plans for line in plan.splitlines())
    assert "Join LeftSemi" not in plans[1]


def test_names_and_texts_in_parts_and_blocks_rank_alike(spark, monkeypatch):
    dice = random.Random(5)
    word = lambda n: "".join(dice.choice("abc ") for _ in range(dice.randrange(1, n)))
    index = ontology.name_index(spark.createDataFrame([(f"n{i:03}", word(8)) for i in range(200)], "id string, name string"))
    texts = spark.createDataFrame([(word(10),) for _ in range(60)] + [("zzz",), (None,)], "text string")
    asked = texts.select("text", F.explode(ontology._grams(ontology.normalised("text"))).alias("gram")).distinct()
    own = asked.join(index.select("gram", "weight").distinct(), "gram").groupBy("text").agg(F.sum("weight").alias("own"))
    met = asked.join(index, "gram").groupBy("text", "id").agg(F.sum("weight").alias("both"), F.max("norm").alias("norm")).join(own, "text")
    told = {}
    for r in met.withColumn("shared", F.expr("both * 1000000 div (norm + own - both)")).collect():
        told.setdefault(r.text, []).append((-r.shared, r.id))
    want = sorted((t, i, -s, k + 1) for t, rows in told.items() for k, (s, i) in enumerate(sorted(rows)[:4]))
    of = lambda: sorted(tuple(r) for r in ontology.ranked_search(texts, index, most=4).collect())
    assert of() == want
    monkeypatch.setattr(ontology, "NAMES", 9)
    monkeypatch.setattr(ontology, "TEXTS", 13)
    assert of() == want
