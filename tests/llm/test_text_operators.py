import base64
import gzip
import hashlib
import json
import os
import random
import re
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidegraph.llm import chat, mixing, packing, quality, tokens, toxicity, warc
from tidegraph.llm.common import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, taken string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "clash", "clash") for i, t, s in rows], DOCS)


ODD = ["don't stop, it's", "İstanbul Éáx , '", "<|endoftext|>Hi <|ENDOFTEXT|> a<|endoftext|>b", "10km,  x\x1cy!\x1c! ", "日本語 text, ñandú!? ..,,", "ſs ǅ ΑΣ é", "  \n\t ", "", None, "x" * 5000 + " é. ßa:; a.b a,! ... ,a ;"]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.public_vocabulary())


def test_token_counts_equal_the_library(spark):
    model = library()
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, "a b", "s"), (3, ODD[3], "s"), (50, "word " * 3000, "s")]
    got = tokens.token_counts(docs_of(spark, rows)).collect()
    want = sorted((str(i), len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert {r.doc_id for r in got if r.over_limit} == {50, 9} & {r.doc_id for r in got if r.n_tokens > 2048} | {50}
    assert tokens.token_counts(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_take_whole_texts(spark, name):
    path = tokens.public_vocabulary(name)
    rows = [(i, t, "s") for i, t in enumerate(ODD)]
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs_of(spark, rows), vocabulary=path).collect()}
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        want = {i: len(model.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows}
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {i: len(model.encode(t or "")) for i, t, _ in rows}
    assert got == want


def test_pieces_of_long_texts_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE_BYTES", 50)
    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    text = " ".join(t for t in ODD if t) * 3
    of = tokens.Encoder(tokens.public_vocabulary(), packing.as_bytes)
    assert b"".join(b"".join(v) for v in of.by_words([text.encode()])) == packing.as_bytes(library().encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_long_texts_are_cut_where_no_token_reaches_over(monkeypatch, name):
    monkeypatch.setattr(tokens, "PIECE_BYTES", 40)
    text = (" ".join(t for t in ODD if t) + " plain words  with two spaces, 10 20 km ") * 3
    of = tokens.Encoder(tokens.public_vocabulary(name), packing.as_bytes)
    assert of.cut is not None and len(list(tokens.safe_pieces(text.encode(), of.cut, 40))) > 5
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        want = Tokenizer.from_file(tokens.public_vocabulary(name)).encode(text, add_special_tokens=False).ids
    else:
        import sentencepiece

        want = sentencepiece.SentencePieceProcessor(model_file=tokens.public_vocabulary(name)).encode(text)
    assert [b"".join(v) for v in of.whole([text.encode(), b"", text.encode()])] == [packing.as_bytes(want), b"", packing.as_bytes(want)]


def test_a_cased_vocabulary_keeps_case(spark, tmp_path):
    with open(tokens.public_vocabulary(), encoding="utf-8") as file:
        rules = json.load(file)
    rules["normalizer"] = {"type": "NFC"}
    path = f"{tmp_path}/cased.json"
    with open(path, "w", encoding="utf-8") as file:
        json.dump(rules, file)
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    assert len(model.encode("HELLO There", add_special_tokens=False).ids) != len(library().encode("HELLO There", add_special_tokens=False).ids)
    rows = [(i, t, "s") for i, t in enumerate([*ODD, "HELLO There hello there"])]
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs_of(spark, rows), vocabulary=path).collect()}
    assert got == {i: len(model.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows}


def test_equal_rows_are_packed_in_several_bins_and_ids_come_back(spark):
    rows = [(1, "one two three four five", "s")] * 600 + [(2, "six " * 9000, "s"), (3, None, "s")]
    packed = packing.pack(docs_of(spark, rows), bin_pieces=200, with_ids=True).cache()
    got = packed.collect()
    assert len({r.sequence_id % 4 for r in got}) == 4 and len(got) == 604
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in got:
        assert bytes(whole[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert all(len(r.ids) == 4 * r.length <= 4 * packing.CAPACITY and len(r.starts) == len(set(r.starts)) for r in whole.values())


def test_packing_covers_every_id_once(spark):
    model, dice = library(), random.Random(2)
    rows = [(i, " ".join(dice.choices(["alpha", "beta,", "gamma", "Δ"], k=dice.choice([0, 5, 300, 2000, 9000]))), "s") for i in range(120)] + [(500, None, "s"), (None, "one two", "s"), (7, "again", "s")]
    got = packing.pack(docs_of(spark, rows), bin_pieces=60).collect()
    ids = defaultdict(list)
    for i, t, _ in rows:
        ids[i].append([*model.encode(t or "", add_special_tokens=False).ids, packing.END_ID])
    sequences = defaultdict(list)
    found = defaultdict(int)
    for r in got:
        match = next(x for x in ids[r.doc_id] if len(x) == r.doc_tokens and zlib.crc32(packing.as_bytes(x[r.start : r.start + r.length])) == r.ids_crc32)
        found[r.doc_id] += r.length
        assert r.start + r.length <= len(match)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == {i: sum(map(len, x)) for i, x in ids.items()}
    for parts in sequences.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(found.values()) > 0.9 * 4096 * len(sequences)
    assert packing.pack(docs_of(spark, [])).count() == 0


def test_minimum_bin_slack_finds_the_best_fill():
    dice = random.Random(4)
    for _ in range(50):
        lengths = defaultdict(int)
        for _ in range(dice.randrange(1, 9)):
            lengths[dice.randrange(1, 40)] += 1
        items = [x for x, n in lengths.items() for _ in range(n)]
        first = next(iter(packing.minimum_bin_slack(lengths, 50)))
        rest = list(items)
        rest.remove(max(items))
        best = max(s for m in range(1 << len(rest)) if (s := max(items) + sum(x for i, x in enumerate(rest) if m >> i & 1)) <= 50)
        assert sum(x * n for x, n in first) == best
        packed = sorted(x for window in packing.minimum_bin_slack(lengths, 50) for x, n in window for _ in range(n))
        assert packed == sorted(items)


def brute_targets(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    goal, capped = share * sum(sizes.values()), set()
    while True:
        left = goal - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return target | {s: most * sizes[s] for s in capped}
        capped |= over


def test_mixing_meets_targets(spark):
    dice = random.Random(8)
    rows = [(i, " ".join(["w"] * dice.randrange(0, 80)), dice.choice(["a", "b", "c", None, "é", "z"]) if i % 3 else "hot") for i in range(2000)]
    rows += [(None, "x y", "a"), (5, rows[5][1], rows[5][2]), (3000, None, "a"), (3001, "", "nothing")]
    plan = mixing.mix_plan(docs_of(spark, rows)).collect()
    assert len(plan) == len(rows)
    sizes, source_of = defaultdict(int), {}
    for i, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    targets = brute_targets(sizes)
    by_target = defaultdict(int)
    for r in plan:
        assert r.taken <= 2 * r.size
        assert r.size == 0 or r.taken % r.size == 0
        by_target[(r.source_size, round(r.target, 6))] += r.taken
    for s, size in sizes.items():
        taken = by_target[(size, round(targets[s], 6))]
        assert abs(taken - targets[s]) <= 40
    again = mixing.mix_plan(docs_of(spark, rows).repartition(3)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    mixed = mixing.mix(docs_of(spark, rows))
    assert mixed.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in plan)
    assert mixing.mix(docs_of(spark, [])).count() == 0
    del source_of


def test_unequal_odds_give_each_document_its_share(spark):
    """400 sources are 400 draws of the same 30 documents; each is taken as often as its weight says."""
    dice = random.Random(4)
    weights = [dice.choice([0.25, 0.5, 1.0, 1.6, 2.2]) for _ in range(30)]
    weights = [w * 30 / sum(weights) for w in weights]
    rows = [(s * 30 + i, " ".join(["w"] * 10), f"s{s}", weights[i]) for s in range(400) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    taken = defaultdict(int)
    for r in mixing.mix_plan(docs, weights=(1,), share=0.6, weight_col="w").collect():
        taken[r.doc_id % 30] += r.taken // 10
    for i, w in enumerate(weights):
        whole, rest = divmod(min(0.6 * w, 2.0), 1)
        spread = (rest * (1 - rest) / 400) ** 0.5
        assert abs(taken[i] / 400 - whole - rest) <= 4 * spread + 0.02
    by_source = defaultdict(int)
    for r in mixing.mix_plan(docs, weights=(1,), share=0.6, weight_col="w", seed="other").collect():
        by_source[r.doc_id // 30] += r.taken
    assert all(abs(n - 180) <= 5 for n in by_source.values())


def test_chat_round_trip(spark):
    marks = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "user", marks), (1, 1, "assistant", marks), (1, 2, "assistant", "[\\INST] \\ <\\\\s> </s"), (2, 0, "[ROLE] x", "a [/TEXT] b"), (2, 1, None, None), (2, 1, "assistant", None), (None, 0, "user", "né"), (None, 0, "user", "né"), (3, None, "assistant", "x" * 100_000)]
    rows = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, part string")
    for part_bytes in (1, 1 << 20):
        chats = chat.format_chats(rows, part_bytes=part_bytes)
        whole = defaultdict(list)
        for r in chats.collect():
            whole[r._conv].append(r)
        parsed = {c: [t for r in sorted(rs, key=lambda r: r.part) for t in chat.parse(r.text)] for c, rs in whole.items()}
        want = defaultdict(list)
        for c, n, r, t in sorted(turns, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
            want[c].append((r or "", t or ""))
        assert parsed == dict(want)
        got = {r.conv_id: r for r in chat.read_back(chats).collect()}
        for c, ts in want.items():
            loss = "".join(t for r, t in ts if r == "assistant")
            assert got[c].n_turns == len(ts)
            assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest()
            assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_chats(rows.limit(0))).count() == 0


def chat_batches(rows, size):
    for i in range(0, len(rows), size):
        conversations, roles, texts = zip(*rows[i : i + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(conversations, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], ["_conv", "_role", "_text"])


def test_chats_do_not_depend_on_batches():
    dice = random.Random(3)
    texts = [None, "", "é</s>[INST] ok [/INST]", "x\\" * 5 + "</s>"]
    rows = [(c, dice.choice(["user", "assistant", "[ROLE] é", None]), dice.choice([*texts, "long " * dice.randrange(5000)])) for c in (None, -7, *range(1, 9)) for _ in range(dice.randrange(1, 6))]
    for part_bytes in (1, 300, 5000, 1 << 24):
        found = [[r for b in chat._formatted(part_bytes)(chat_batches(rows, size)) for r in b.to_pylist()] for size in (1, 2, 7, 1000)]
        assert all(f == found[0] for f in found)
        for r in found[0]:
            said = [t for role, t in chat.parse(r["text"]) if role == "assistant"]
            assert [chat.unescape(r["text"][a:b]) for a, b in zip(r["loss_starts"], r["loss_ends"], strict=True)] == said
        got = defaultdict(list)
        for r in found[0]:
            got[r["_conv"]].extend(chat.parse(r["text"]))
        want = defaultdict(list)
        for c, role, text in rows:
            want[c].append((role or "", text or ""))
        assert got == want


def test_turns_of_100_mb_cost_a_few_times_their_size():
    code = """
import resource
import pyarrow as pa
from tidegraph.llm import chat
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
def batches():
    for _ in range(4):
        yield pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["user"]), pa.array(["word é " * 12_500_000])], ["_conv", "_role", "_text"])
before, size = peak(), 0
for batch in chat._formatted(chat.PART_BYTES)(batches()):
    size += len(batch.column("text")[0].as_buffer())
assert size > 400e6
print(peak() - before)
"""
    grown = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()[-1])
    assert grown < 800


def test_formatted_turns_hold_no_bare_mark():
    texts = ["<s>", "[INST]", "[\\INST]", "[[INST]]", "<<s>>", "[/TEXT]", "\\", "[ROLE"]
    done = chat.format_turns(pa.array(["user"] * len(texts)), pa.array(texts))
    whole = done.buffer.to_pybytes().decode()
    for i, text in enumerate(texts):
        own = whole[done.text_start[i] : done.text_end[i]]
        assert not re.search(r"</?s>|\[/?(INST|ROLE|TEXT)\]", own)
        assert chat.unescape(own) == text


def test_warc_round_trip(spark):
    pages = [(5, "http://a/", "<p>é</p>"), (3, "http://b/\r\nX: y", "<p>é</p>"), (3, "http://b2/", "<p>é</p>"), (9, None, None), (None, "http://n/", ""), (4, "http://c/", "WARC/1.1\r\n\r\n" * 50), (6, "u", "z" * 3_000_000)]
    rows = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, archive string")
    plain, target = new_folder(spark, "plain"), new_folder(spark, "target")
    warc.write_archives(warc.records(rows), plain)
    index = warc.normalise(spark, plain, target)
    got = sorted(warc.read_archives(index).collect(), key=str)
    assert len(got) == len(pages)
    responses = [r for r in got if r.record_type == "response"]
    assert sorted(bytes(r.payload) for r in responses) == sorted({(h or "").encode() for _, _, h in pages})
    for r in responses:
        assert r.payload_digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {"<urn:page:3>", "<urn:page:9>"}
    assert sum(r.record_id == "<urn:page:3>" and r.record_type == "response" for r in got) == 1
    folder = target.removeprefix("file://")
    for entry in index.collect():
        with open(entry.archive.removeprefix("file://"), "rb") as file:
            file.seek(entry.offset)
            assert gzip.decompress(file.read(entry.length)).startswith(b"WARC/1.1\r\n")
    assert folder
    empty, none = new_folder(spark, "plain"), new_folder(spark, "target")
    warc.write_archives(warc.records(rows.limit(0)), empty)
    assert warc.read_archives(warc.normalise(spark, empty, none)).count() == 0


def test_warc_least_bytes_and_broken_archives(spark):
    rows = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = [r.value.split("\r\n")[1] for r in warc.records(rows, least_bytes=3).collect()]
    assert sorted(kinds) == ["WARC-Type: response"] * 3 + ["WARC-Type: revisit"]
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    members = gzip.compress(record) + gzip.compress(record * 2)
    blocks = [members[i : i + 7] for i in range(0, len(members), 7)]
    assert [r for _, r in warc.split_records(warc.inflate(blocks))] == [record] * 3
    with pytest.raises(ValueError):
        list(warc.split_records([record[:-6]]))
    # cut between two records: nothing is missing but the end of the stream
    with pytest.raises(ValueError, match="cut"):
        list(warc.inflate([gzip.compress(record)[:-8]]))
    bomb = gzip.compress(b"\0" * (50 << 20))
    pieces = [len(p) for p in warc.inflate([bomb])]
    assert max(pieces) <= 1 << 20 and sum(pieces) == 50 << 20


def test_a_normaliser_that_runs_again_replaces_its_files(spark):
    plain, target = new_folder(spark, "plain"), new_folder(spark, "again")
    warc.write_archives(warc.records(spark.createDataFrame([(i, "u", f"page {i}" * 50) for i in range(40)], "page_id long, url string, html string")), plain)
    one, other = (sorted(map(tuple, warc.normalise(spark, plain, target).collect())) for _ in range(2))
    assert one == other and len(one) == 40
    assert warc.read_archives(warc.normalise(spark, plain, target)).count() == 40


def toxic_rows(count=1200):
    dice, bad = random.Random(9), ["idiot", "moron", "scumbag"]
    rows, labels = [], []
    vocabulary = ["".join(dice.choices("abcdeghilmnorstu", k=dice.randrange(2, 9))) for _ in range(500)]
    for i in range(count):
        words = dice.choices(vocabulary, k=dice.randrange(20, 200))
        toxic = i % 4 == 0
        if toxic:
            for at in dice.sample(range(len(words)), max(1, len(words) // 50)):
                words[at] = dice.choice(bad) + dice.choice(["", "s", "ic"])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_holds_out_and_generalises(spark):
    rows, labels = toxic_rows()
    extra = [(9000, None, "s"), (9001, "", "s"), (None, "some words", "s"), (9002, "you idiotss morron", "s"), (9003, "thing " * 50_000, "s")]
    known = spark.createDataFrame([*labels, (9000, None, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs_of(spark, rows + extra), known).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    by = {r.doc_id: r for r in got}
    assert by[9002].predicted == 1 and by[9003].predicted == 0 and by[9000].score == by[9001].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    kept = toxicity.drop_toxic(docs_of(spark, rows), known)
    assert kept.columns == docs_of(spark, rows).columns and kept.count() < len(rows)
    assert toxicity.toxicity(docs_of(spark, []), known).count() == 0
    none = toxicity.toxicity(docs_of(spark, rows[:3]), known.limit(0)).collect()
    assert len({r.score for r in none}) == 1


def test_toxicity_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = toxic_rows(200)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, q, y in labels]
    schema = "doc_id long, quality int, toxic int"
    one, other = (sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs_of(spark, rows), spark.createDataFrame(x, schema)).collect()) for x in (labels, flipped))
    assert one == other


def test_a_repeated_word_counts_once_in_a_window():
    scores = np.array([1.0, 9.0, 9.0, 9.0, 9.0, 2.0])
    assert toxicity.strongest(scores, 4) == (2, pytest.approx((9.0 + 2.0) / 4)) or toxicity.strongest(scores, 4)[1] <= 11 / 4
    assert toxicity.strongest(np.array([]), 4) == (0, 0.0)


def test_label_model_recovers_accuracies():
    dice = np.random.default_rng(0)
    truth = dice.random(4000) < 0.7
    right = (0.9, 0.8, 0.7, 0.85)
    cast = np.array([[0 if dice.random() < 0.3 else (1 if y else -1) * (1 if dice.random() < a else -1) for a in right] for y in truth])
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    model = quality.expectation_maximisation(list("abcd"), patterns, counts.astype(float))
    assert np.allclose(list(model.accuracies().values()), right, atol=0.05)
    assert abs(model.good - 0.7) < 0.05


def test_quality_keeps_prose_and_drops_junk(spark):
    dice = random.Random(6)
    word = lambda: "".join(dice.choices("abcdefghilmnoprstu", k=dice.randrange(2, 9)))
    prose = lambda: " ".join((" ".join(word() for _ in range(9))).capitalize() + "." for _ in range(8))
    junk = lambda: dice.choice([" | ".join(word() for _ in range(60)), (word() + " ") * 80, " ".join(word() + "$$$" for _ in range(60)), " ".join(word().upper() + "!!" for _ in range(60))])
    rows = [(i, prose() if i % 5 else junk(), "s") for i in range(300)] + [(900, None, "s"), (901, "", "s"), (None, prose(), "s"), (902, prose() * 300, "s"), (1, "x", "s")]
    got = quality.quality(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.keep for r in got}
    assert sum(kept[i] == bool(i % 5) for i in range(2, 300)) >= 290
    assert kept[902] and kept[None] and not kept[900]
    assert quality.quality(docs_of(spark, [])).count() == 0


def test_counts_of_texts_equal_a_loop_over_words():
    dice = random.Random(1)
    for _ in range(300):
        text = "".join(dice.choices("aaZé9.,!?'\"()-$&|_ß日  \n\t\x1c", k=dice.randrange(0, 60)))
        words = text.encode().split()
        want = [len(words), 0, 0, 0, 0, 0, 0, sum(a.decode().lower() == b.decode().lower() for a, b in zip(words, words[1:], strict=False)), len({w.decode().lower() for w in words})]
        for word in (w.decode() for w in words):
            known = [c for c in word if c.isalnum()]
            ends = word.rstrip("\"')")[-1:] in (".", "!", "?") and bool(known)
            own = (len(word), sum(not c.isalnum() and c not in ".,;:!?'\"()-" for c in word), sum(c.isupper() for c in known), sum(c.isdigit() for c in known), not known, ends)
            want[1:7] = [a + b for a, b in zip(want[1:7], own, strict=True)]
        got, hashes, shapes = quality.analysed(text.encode())
        assert got == want and len(hashes) == len(shapes) == len(words)
    _, one, shape = quality.analysed(b"Hello HELLO abc ab a Abc, ABc,")
    assert one[0] == one[1] and shape[2] == shape[3] != shape[4] and len(set(shape.tolist())) == 6


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_quality_of_labelled_rows_by_labeller_model_and_scorer(spark):
    """No label trains anything, so all labelled rows are held out. Labellers contradict one another; model and scorer beat them all."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    voted = [r for r in quality.votes(docs).collect() if r._id in truth]
    names = list(quality.labellers())
    assert sum(len({r[n] for n in names} - {0}) == 2 for r in voted) > 20
    right = {}
    for n in names:
        cast = [(r[n] > 0) == bool(truth[r._id]) for r in voted if r[n]]
        if cast:
            right[n] = (sum(cast) / len(cast), len(cast))
    got = [r for r in quality.quality(docs).collect() if r.doc_id in truth]
    share = lambda says: sum(says(r) == bool(truth[r.doc_id]) for r in got) / len(got)
    model, scorer = share(lambda r: r.posterior >= 0.5), share(lambda r: r.score >= 0.5)
    print(right, model, scorer)
    assert model >= 0.95 and scorer >= 0.95
    assert all(scorer >= accuracy for accuracy, cast in right.values() if cast > 0.5 * len(got))


def test_a_word_counts_once_in_each_window():
    scores = np.zeros(400)
    scores[::10], scores[205] = 5, 4
    assert toxicity.strongest(scores)[1] * 16 == 9
    dice = np.random.default_rng(4)
    for size in (1, 5, 15, 16, 17, 60):
        for _ in range(20):
            scores = dice.integers(-5, 6, size).astype(float)
            want = [sum(set(scores[at : at + 16].tolist())) / 16 for at in range(max(1, size - 15))]
            at, got = toxicity.strongest(scores)
            assert np.isclose(got, max(want)) and np.isclose(want[at], got)
