import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest

from tidegraph.llm import alignment, completion, encoders, merkle
from tidegraph.llm.common import table
from tidegraph.llm.tokens import public_vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, piece string, _row string"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["don't stop, it's <|endoftext|> now", "<s> </s> x", "", None, "a▁b", "日本語 text, ñandú!? ..,,\n\n x\x00\x1c", "ab" * 500 + " é" * 400, " " * 700, "  \n\t ", "👍🏽 " * 60, "word " * 3000]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "clash", "clash", "clash") for i, t, s in rows], DOCS)


# ------------------------------------------------------------------ encoders


def tokenizer(specials_plain):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_vocabulary(BYTES))
    model.encode_special_tokens = specials_plain
    return model


@pytest.mark.parametrize("plain", [True, False])
def test_byte_level_ids_are_the_librarys(monkeypatch, plain):
    monkeypatch.setattr(encoders, "PIECE", 50)
    of, model = encoders.ByteLevel(public_vocabulary(BYTES), plain), tokenizer(plain)
    assert of.fast
    for text in ODD:
        if text:
            assert [x for part in encoders.cut(text, 50) for x in of._ids(part)] == of.ids(text).tolist() == model.encode(text, add_special_tokens=False).ids


def test_pieces_are_the_librarys(monkeypatch):
    monkeypatch.setattr(encoders, "PIECE", 50)
    of = encoders.Pieces(public_vocabulary(PIECES))
    for text in [*filter(None, ODD), "x" * 50 + " ", "x" * 50 + "  "]:
        assert of.ids(text).tolist() == of.model.encode(text)


def test_words_read_apart_are_the_text_read_whole(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 40)
    both, model = alignment.Sides(public_vocabulary(BYTES), public_vocabulary(PIECES)), tokenizer(True)
    texts = [*ODD, "a ", "a  ", "so, so  é \t and so on.\nThen", "ends in 語 then a word", *(" ".join(random.Random(i).choices(["Gezeiten,", "über", "né", "(x)", "12", "語", " "], k=60)) for i in range(30))]
    for text, found in zip(texts, both.read(t or "" for t in texts), strict=True):
        if not text or "▁" in text:
            assert found is None
        else:
            assert [np.frombuffer(x, k).tolist() for x, k in zip(found, both.kinds, strict=True)] == [model.encode(f" {text}", add_special_tokens=False).ids, both.b.model.encode(text)]


# ------------------------------------------------------------------ bin completion


def optimum(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


def test_completion_is_at_most_best_fit_and_mostly_the_optimum():
    rng, optimal = random.Random(3), 0
    for _ in range(120):
        items = sorted((rng.randint(15, 70) for _ in range(rng.randint(1, 11))), reverse=True)
        lengths = Counter(items)
        found, want = completion.complete(lengths, 100, effort=100), optimum(items, 100)
        assert Counter(x for f in found for x in f) == lengths and all(sum(f) <= 100 for f in found)
        assert completion.least(lengths, 100) <= want <= len(found) <= len(completion.best_fit(lengths, 100))
        optimal += len(found) == want
    assert optimal >= 114


def test_completion_beats_best_fit():
    # best fit puts 42 by 58 and is left with pieces that no longer fit
    lengths = Counter({44: 2, 42: 2, 40: 2, 36: 2, 28: 2, 22: 2, 12: 2, 8: 4})
    assert len(completion.complete(lengths, 100)) == completion.least(lengths, 100) <= len(completion.best_fit(lengths, 100))
    sizes = np.random.default_rng(1).integers(200, 420, 3000).tolist()
    assert len(completion.complete(Counter(sizes), 1024)) < len(completion.best_fit(Counter(sizes), 1024))


def test_dominated_fillings_are_told():
    stock = completion.Stock(Counter({60: 1, 35: 1, 30: 2, 25: 1}))
    assert stock.dominated((30, 25), 5) and stock.dominated((30, 30), 0)
    assert not stock.dominated((60,), 0) and stock.dominated((35, 25), 0)
    assert stock.fillings(60, 60) == [(60,)]
    assert stock.fillings(20, 20) == [()] and stock.fillings(20, 5) == []


@pytest.mark.parametrize("group_pieces", [25_000, 20])
def test_packed_pieces_hold_every_id_once(spark, group_pieces):
    rng = random.Random(5)
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, "a b", "s"), (None, "a b", "s"), (2, ODD[0], "s"), (99, "x y z " * 2000, "s")]
    rows += [(100 + i, " ".join(rng.choices(["tide", "Graph,", "of", "12"], k=rng.randint(1, 900))), "s") for i in range(60)]
    got = completion.pack(docs_of(spark, rows), group_pieces=group_pieces).collect()
    model, want = tokenizer(False), Counter()
    for i, text, _ in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        bounds = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for n, (low, high) in enumerate(pairwise(bounds)):
            want[i, n, low, high - low, zlib.crc32(np.array(ids[low:high], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
    short = Counter(r.length for r in got if r.length < 1024)
    full = sum(r.length == 1024 for r in got)
    groups = -(-sum(short.values()) // group_pieces)
    assert full + completion.least(short, 1024) <= len(sequences) <= full + len(completion.best_fit(short, 1024)) + 3 * (groups - 1)
    assert completion.pack(docs_of(spark, [])).count() == 0


def test_op11_takes_whole_documents(spark):
    got = completion.op11_completion(spark, "/root/testdata/sf0.001")
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    model = tokenizer(False)
    sizes = {r.doc_id: len(model.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs}
    lengths = defaultdict(int)
    for r in got.collect():
        lengths[r.doc_id] += r.length
    assert dict(lengths) == sizes
    short = Counter(n % 1024 for n in sizes.values() if n % 1024)
    assert got.select("sequence_id").distinct().count() <= sum(n // 1024 for n in sizes.values()) + len(completion.best_fit(short, 1024))


# ------------------------------------------------------------------ Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(nodes):
    """The levels of a tree, each with its nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def along(levels, at, own):
    beside = []
    for level in levels[:-1]:
        run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(level)))
        beside += [level[i] for i in run if i != at]
        own = digest(*(own if i == at else level[i] for i in run))
        at //= 3
    return own, beside


def brute_merkle(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for i, source, lang, n, text in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        changed = text.replace("\n", "") if hit and text is not None else text
        groups[source].append(((i is not None, i or 0), leaf((i, source, lang, n, text)), leaf((i, source, lang, n, changed)), i))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = up([x[1] for x in groups[name]])
    top = up([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for at, (_, own, other, i) in enumerate(groups[name]):
            sub, beside = along(trees[name], at, other)
            whole, above = along(top, place, sub)
            found.append((i, own, trees[name][-1][0], top[-1][0], digest(*beside, *above), whole))
    return found


@pytest.mark.parametrize("sizes", [[2], [81, 82, 3], [243, 1, 7, 244, 1, 1, 1, 1, 1, 30]])
def test_proofs_equal_a_plain_tree(spark, tmp_path, sizes):
    rng, rows = random.Random(7), []
    for k, n in enumerate(sizes):
        for _ in range(n):
            i = len(rows)
            rows.append((i, [None, "é", "z", "a"][k] if k < 4 else f"s{k}", None if i % 5 == 0 else "en", i, None if i % 7 == 0 else "line\n" * rng.randint(0, 3)))
    rows += [(rows[0][0], *rows[0][1:]), (None, None, None, None, None)] if len(sizes) > 4 else []
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle.op12_merkle(spark, str(tmp_path)).collect()
    want = brute_merkle(rows)
    assert sorted(map(str, ((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got))) == sorted(map(str, want))
    assert all(r.verified == (r.folded_root == r.root) for r in got)


def test_manifest_of_an_empty_table_and_of_other_fields(spark):
    assert merkle.manifest(docs_of(spark, [])).root() is None
    assert merkle.manifest(docs_of(spark, [])).leaves().count() == 0
    docs = docs_of(spark, [(i, f"t{i % 9}", f"s{i % 4}") for i in range(100)])
    found = merkle.manifest(docs, fields=["text"], group="source", order="doc_id")
    assert found.leaves().where("folded = root").count() == 100
    # one more character anywhere is another root
    other = docs_of(spark, [(i, f"t{i % 9}" + "!" * (i == 57), f"s{i % 4}") for i in range(100)])
    assert merkle.manifest(other, fields=["text"]).root() != found.root()


# ------------------------------------------------------------------ cross-tokenizer alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_alignment(rows):
    import sentencepiece

    model, pieces = tokenizer(True), sentencepiece.SentencePieceProcessor(model_file=public_vocabulary(PIECES))
    letters, found, count = encoders.byte_alphabet(), [], Counter()
    for i, text, *_ in rows:
        groups, a, b = [], [], []
        if text:
            a, b = model.encode(f" {text}", add_special_tokens=False).ids, pieces.encode(text)
            as_bytes = [[bytes(letters[c] for c in model.id_to_token(x)) for x in a], [bytes([int(pieces.id_to_piece(x)[3:5], 16)]) if pieces.is_byte(x) else pieces.id_to_piece(x).replace("▁", " ").encode() for x in b]]
            if any(b"".join(x) != f" {text}".encode() for x in as_bytes):
                a, b = [], []
            ends = [np.cumsum([len(x) for x in own]).tolist() for own in as_bytes]
        if a:
            low = 0
            for end in sorted(set(ends[0]) & set(ends[1])):
                groups.append(tuple([x for x, e in zip(own, at, strict=True) if low < e <= end] for own, at in zip((a, b), ends, strict=True)))
                low = end
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
        found.append((i, a, b, groups))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for i, a, b, groups in found:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[k] == most[k[0]] for k in links), sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


@pytest.mark.parametrize("span, hot", [(1 << 15, 150_000), (64, 20), (200, 0)])
def test_alignment_equals_brute_force(spark, span, hot):
    rows = [(i, t[:1200] if t else t, "s") for i, t in enumerate(ODD)] + [(None, "hello world", "s"), (None, "hello world", "s"), (3, "hello other worlds", "s")]
    got = alignment.alignments(docs_of(spark, rows), span=span, hot=hot).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_alignment(rows)))
    assert alignment.alignments(docs_of(spark, [])).count() == 0


def test_groups_of_many_links_count_distinct_ids(spark, monkeypatch):
    machine = alignment.Machine([np.ones(50, np.int64), np.ones(50, np.int64)], 1 << 15)
    monkeypatch.setattr(alignment, "MANY", 4)
    monkeypatch.setattr(alignment, "AT_ONCE", 5)
    rng = np.random.default_rng(2)
    machine.start()
    sides, bounds = [rng.integers(0, 50, 60), rng.integers(0, 50, 45)], [np.array([0, 1, 20, 22, 60]), np.array([0, 1, 30, 31, 45])]
    machine.close(sides, bounds)
    *_, keys, times = machine.result()
    want = Counter(int(x) << 32 | int(y) for (a, b), (c, d) in zip(pairwise(bounds[0]), pairwise(bounds[1]), strict=True) for x in sides[0][a:b] for y in sides[1][c:d])
    assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == want


def test_op13_equals_brute_force_over_a_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = alignment.op13_alignment(spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(brute_alignment(rows))


def test_frequent_pairs_are_bounded(spark):
    counts = spark.createDataFrame([(i, n, True) for i, n in enumerate([1] * 50 + [2, 3] * 10 + [8] * 5 + [1 << 40])], "_key long, _n long, _best boolean")
    for most in (0, 1, 5, 6, 26, 75, 76, 1000):
        reach = alignment._frequent(counts, most)
        assert counts.where(counts["_n"] >= reach).count() <= most
    assert alignment._frequent(counts, 1000) == 1
