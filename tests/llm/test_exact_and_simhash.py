import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tidegraph.llm import exact_dedup, simhash, similar
from tidegraph.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, fingerprint int"


def frame(spark, rows, schema=SCHEMA):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


CASES = [(1, "a b"), (2, "a b"), (2, "a b"), (3, None), (4, ""), (None, "a b"), (None, "alone"), (7, "x" * 300_000), (8, "x" * 300_000), (9, "é")]


def test_exact_groups_of_edge_cases(spark):
    got = exact_dedup.exact_groups(frame(spark, CASES)).collect()
    assert len(got) == len(CASES)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert [r.group_size for r in by[sha("a b")]] == [4] * 4
    assert {r.keep_id for r in by[sha("a b")]} == {2}
    assert {r.keep_id for r in by[sha("")]} == {4}
    assert {r.keep_id for r in by[sha("alone")]} == {None}
    assert all(sum(r.kept for r in rows) == 1 for rows in by.values())


def test_exact_dedup_keeps_columns_and_one_row(spark):
    docs = frame(spark, [(1, "a", "en", "s", 1, "clash", 5), (1, "a", "en", "s", 1, "clash", 5), (0, "a", "de", "s", 1, "c", 6), (None, None, None, None, None, None, None)])
    got = exact_dedup.drop_exact_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or -1, r.kept) for r in got.collect()) == [(-1, None), (1, "clash")]


def test_exact_dedup_of_empty_table(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0
    assert exact_dedup.drop_exact_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("budget", [1, 3_000, 1 << 20])
def test_grace_spills_and_still_compares_whole_contents(budget):
    dice = random.Random(1)
    records = [(bytes([dice.randrange(3)]) * dice.randrange(1, 400), dice.randrange(1000), 1, 1) for _ in range(3000)]
    want = defaultdict(lambda: [-1, 0])
    for what, i, n, _ in records:
        want[what] = [max(want[what][0], i), want[what][1] + n]
    got = list(exact_dedup.grace(records, budget))
    assert len(got) == len(want)
    assert {r[0]: [r[1], r[2]] for r in got} == dict(want)
    folded = list(exact_dedup.grace(exact_dedup.combine(records, budget), budget))
    assert {r[0]: [r[1], r[2]] for r in folded} == dict(want)


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(count=150):
    dice = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(count):
        words = dice.choices(vocabulary, k=120)
        for _ in range(dice.randrange(1, 4)):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[dice.randrange(120)] = "changed"
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "One"), (None, "one"), (len(rows) + 3, "a b c " * 20_000)]


@pytest.mark.parametrize("heavy", [50_000, 2])
def test_simhash_components_equal_brute_force(spark, heavy):
    rows = near_texts()
    got = simhash.near_duplicates(frame(spark, rows), heavy=heavy).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), d)
    want = sorted((d if d is not None else -1, f"{prints[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("budget", [1, 3, 8])
def test_trie_join_equals_all_pairs(budget):
    dice = np.random.default_rng(budget)
    centres = dice.integers(0, 2**63, 12, dtype=np.uint64)
    values = sorted({int(c) ^ sum(1 << int(b) for b in dice.integers(0, 64, dice.integers(0, 6))) for c in centres for _ in range(40)})
    pairs = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() <= budget}
    forest = simhash.TrieJoin(values, budget)
    assert {tuple(sorted(p)) for p in forest.pairs} <= pairs
    assert all(forest.find(i) == forest.find(j) for i, j in pairs)
    assert len(forest.pairs) == len(values) - len({forest.find(i) for i in range(len(values))})


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2)]
    got = {r.vertex: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_groups_decide_by_shingles(spark):
    dice = random.Random(5)
    words = [f"word{i}" for i in range(1000)]
    rows, families = [], []
    for _ in range(30):
        base = dice.choices(words, k=200)
        family = [len(rows)]
        rows.append((len(rows), " ".join(base)))
        for changes in (1, 2, 12):
            other = list(base)
            for at in dice.sample(range(200), changes):
                other[at] = f"new{dice.randrange(10**6)}"
            if changes < 12:
                family.append(len(rows))
            rows.append((len(rows), " ".join(other)))
        families.append(family)
    rows += [(None, None), (len(rows), ""), (len(rows) + 1, "short text"), (len(rows) + 2, "short text here")]
    docs = frame(spark, rows)
    kept = similar.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    gone = {i for family in families for i in family[1:]}
    assert {i for i, _ in rows if i is not None} - ids == gone
    # the row without text or id is like the empty one, which has an id and stays
    assert None not in ids
    assert similar.drop_near_duplicates(frame(spark, [])).count() == 0


def far_bits(one, other):
    one, other = (simhash.fingerprint(" ".join(sorted(set(x.split()))).encode(), 1) for x in (one, other))
    return ((one ^ other) % (1 << 64)).bit_count()


def test_links_beyond_the_budget_are_found(spark):
    dice = random.Random(8)
    word = lambda: f"w{dice.randrange(10**9)}"
    rows, far = [], 0
    for i in range(40):
        base = [word() for _ in range(200)]
        ends = [base[:-20] + [word() for _ in range(20)], base[:-24] + [word() for _ in range(24)]]
        rows += [(3 * i + j, " ".join(x)) for j, x in enumerate([base, *ends])]
        far += far_bits(rows[-3][1], rows[-2][1]) > similar.BUDGET
    assert far >= 10
    want = {i for i in range(120) if i % 3 != 1}
    assert {r.doc_id for r in similar.drop_near_duplicates(frame(spark, rows)).collect()} == want
    # frequent shingles that are dealt into parts
    rows += [(1000 + i, " ".join(["all of them have this line too", *(word() for _ in range(5))])) for i in range(60)]
    rows += [(2000, "all of them have this line too yes"), (2001, "all of them have this line too yes yes"), (2002, "all of them have this line too yes yes yes")]
    got = {r.doc_id for r in similar.drop_near_duplicates(frame(spark, rows), heavy=20, budget=1, blocks=3).collect()}
    assert got == want | {*range(1000, 1060), 2000, 2001, 2002} - {i for i, _ in rows if i in linked(rows)}


def linked(rows):
    """Rows that share 0.8 of their shingles with one of a lesser id, by brute force."""
    sets = [(i, set(simhash.shingle_hashes(x.encode(), 5).tolist())) for i, x in rows]
    return {j for n, (j, y) in enumerate(sets) for i, x in sets[:n] if x and len(x & y) >= 0.8 * len(x | y)}


def test_bitmaps_rule_out_no_link():
    dice = np.random.default_rng(9)
    for n, m, both in ((1, 1, 1), (5, 300, 5), (100, 130, 90), (1000, 900, 850)):
        shared = dice.integers(-(1 << 62), 1 << 62, both)
        one, other = (np.unique(np.concatenate([shared, dice.integers(-(1 << 62), 1 << 62, k - both)])) for k in (n, m))
        assert similar.apart(similar.bitmap(one), similar.bitmap(other)) <= n + m - 2 * both


def test_bitmaps_of_many_rows_equal_those_of_two():
    dice = np.random.default_rng(4)
    sets = [np.unique(dice.integers(-(1 << 62), 1 << 62, n)) for n in (1, 60, 64, 65, 100, 130, 129, 300, 1000)]
    bits = np.empty(len(sets), object)
    bits[:] = [similar.bitmap(x) for x in sets]
    one, other = (x.ravel() for x in np.meshgrid(np.arange(9), np.arange(9)))
    for most in (0, 30, 60, 150):
        want = [similar.apart(bits[i], bits[j]) <= most for i, j in zip(one, other, strict=True)]
        assert similar.Bitmaps(bits).within(one, other, np.full(81, most)).tolist() == want


def test_a_bridge_that_is_not_similar_hides_no_link(spark):
    dice = random.Random(11)
    word = lambda: f"w{dice.randrange(10**9)}"
    rows, bridged = [], 0
    for _ in range(400):
        base = [word() for _ in range(200)]
        end, middle = base[:-20] + [word() for _ in range(20)], base[:-10]
        # words halfway between both, in an order that shares no shingle
        middle += end[-10:]
        dice.shuffle(middle)
        one, other, between = " ".join(base), " ".join(end), " ".join(middle)
        if 9 <= far_bits(one, other) <= 12 and max(far_bits(one, between), far_bits(between, other)) <= 8:
            rows += [(len(rows) + i, x) for i, x in enumerate((one, other, between))]
            bridged += 1
        if bridged == 8:
            break
    assert bridged == 8
    for budget, blocks in ((similar.BUDGET, similar.BLOCKS), (8, 10)):
        kept = {r.doc_id for r in similar.drop_near_duplicates(frame(spark, rows), budget=budget, blocks=blocks).collect()}
        assert kept == {i for i in range(24) if i % 3 != 1}


def family(members, seed=5):
    """Texts that differ from one of 150 words in a few of its words each, so that pairs are about as similar as asked."""
    dice = random.Random(seed)
    base, rows = [f"b{i}" for i in range(150)], []
    for i in range(members):
        words = list(base)
        for place in dice.sample(range(60), 3):
            words[place] = f"x{dice.randrange(40)}"
        rows.append((i, " ".join(words)))
    return rows


def groups_of(rows):
    """Each row's least id over links, by brute force."""
    sets = [set(simhash.shingle_hashes(x.encode(), 5).tolist()) for _, x in rows]
    least = [i for i, _ in rows]
    for n, x in enumerate(sets):
        for m, y in enumerate(sets[:n]):
            if least[n] != least[m] and len(x & y) >= 0.8 * len(x | y):
                one, other = sorted((least[n], least[m]))
                least = [one if i == other else i for i in least]
    return least


def test_pairs_of_a_large_family_are_no_rows(spark, monkeypatch):
    rows, made, links = family(300), [], similar._checked

    def told(pairs, *others):
        made.append(pairs.count())
        return links(pairs, *others)

    monkeypatch.setattr(similar, "_checked", told)
    want = groups_of(rows)
    found = {r.doc_id: r.group for r in similar.similar_groups(frame(spark, rows), heavy=200).collect()}
    assert [found.get(i, i) for i in range(300)] == want and 1 < len(set(want)) < 300
    # of 44,850 pairs
    assert max(made) < 1000, made


def test_a_spanning_forest_joins_what_links_join():
    rows = family(60, 9)
    sets = np.empty(60, object)
    sets[:] = [np.unique(simhash.shingle_hashes(x.encode(), 5).view(np.int64)) for _, x in rows]
    found = similar.spanning(np.arange(60), sets, 0.8)
    want = np.array(groups_of(rows))
    one, other = np.array(found).T
    assert similar.joined(np.arange(60), one, other).tolist() == want.tolist() and len(found) == 60 - len(set(want.tolist()))
    assert similar.spanning(want, sets, 0.8) == []


def test_near_duplicates_of_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "a", 1), (5, text, "b", 2), (2, text + " more", "c", 3), (None, text, "d", 4), (9, "other", None, 5), (8, None, "e", 6), (7, " \n", "f", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _who string, _WHO_ int")
    kept = similar.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # repeated ids and texts go together, texts without words are alike, the least id stays
    assert {tuple(r)[2:] for r in kept.collect()} == {("c", 3), (None, 5), ("f", 7)}
    groups = sorted((r.doc_id is None, r.doc_id or 0, r.group) for r in similar.similar_groups(docs).collect())
    assert groups == [(False, 2, 2), (False, 5, 2), (False, 5, 2), (False, 7, 7), (False, 8, 7), (True, 0, 2)]
    for function in (similar.similar_groups, similar.drop_near_duplicates):
        assert function(docs.limit(0)).count() == 0


def test_shared_rows_of_keys_over_batches():
    import pyarrow as pa

    dice = random.Random(2)
    rows = sorted((dice.randrange(40), dice.choice([-1, -1, -1, 0]), i) for i in range(60))
    seen = [(k, s) for k, s, _ in rows]
    want = [r for r in rows if r[1] >= 0 or seen.count(r[:2]) > 1]
    for size in (1, 2, 3, 7, 60):
        batches = (pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size], strict=True)], ["_key", "_salt", "_leaf"]) for i in range(0, 60, size))
        got = [tuple(r.values()) for batch in similar._shared(batches) for r in batch.to_pylist()]
        assert got == want
