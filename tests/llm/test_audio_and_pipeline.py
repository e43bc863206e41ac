import io
import struct
import wave

import numpy as np

import corpus_pipeline
from tidegraph.llm import audio, registry


def wav(samples, rate=audio.RATE, width=2, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as file:
        file.setnchannels(channels)
        file.setsampwidth(width)
        file.setframerate(rate)
        file.writeframes(np.repeat((samples * 20000).astype("<i2"), channels).tobytes())
    return out.getvalue()


def tune(dice, notes=60):
    steps = dice.integers(0, 24, notes)
    return np.sin(2 * np.pi * np.cumsum(np.repeat(220 * 2 ** (steps / 12) / audio.RATE, audio.NOTE)))


def sound(samples, rate, kind):
    """A WAV file of integers of 8 to 32 bits or of floats, by hand."""
    if kind == "i3":
        values = (samples * (1 << 22)).astype(np.int64)
        data = np.stack([values & 255, values >> 8 & 255, values >> 16 & 255], axis=1).astype(np.uint8).tobytes()
    elif kind == "u1":
        data = np.round(127.5 + samples * 100).astype(np.uint8).tobytes()
    else:
        data = (samples if kind[1] == "f" else samples * (1 << 8 * int(kind[-1]) - 2)).astype(kind).tobytes()
    width = int(kind[-1])
    # an extensible format, and a chunk of odd length that means nothing here
    form = struct.pack("<HHIIHHHHIH14s", 0xFFFE, 1, rate, rate * width, width, 8 * width, 22, 8 * width, 0, 3 if kind[1] == "f" else 1, b"")
    body = b"WAVEnote" + struct.pack("<I", 3) + b"abc\0fmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def played(dice, rate, seconds=8.0):
    """A tune with an overtone, whatever the rate."""
    notes, at = dice.integers(0, 24, 80), np.arange(int(seconds * rate)) / rate
    phase = 2 * np.pi * np.cumsum(220 * 2 ** (notes[(at / 0.128).astype(int)] / 12)) / rate
    return 0.5 * np.sin(phase) + 0.2 * np.sin(2 * phase)


def test_rates_and_kinds_of_numbers_give_the_same_codes():
    of = lambda data: audio.codes(audio.chroma(*audio.blocks_of(data)))[0]
    plain = of(wav(played(np.random.default_rng(0), 4000)))
    for kind in ("u1", "<i2", "i3", "<i4", "<f4", "<f8"):
        assert np.bitwise_count(of(sound(played(np.random.default_rng(0), 4000), 4000, kind)) ^ plain).sum() <= 0.01 * 32 * len(plain)
    for rate in (8000, 11_025, 22_050, 44_100, 48_000):
        other = of(sound(played(np.random.default_rng(0), rate), rate, "i3"))
        size = min(len(plain), len(other))
        assert abs(len(other) - len(plain)) <= 1 and np.bitwise_count(other[:size] ^ plain[:size]).sum() <= 0.02 * 32 * size
    for nothing in (None, b"", b"RIFF", b"noise" * 20, sound(np.zeros(10), 4000, "<i2")[:30]):
        assert len(of(nothing)) == 0


def test_long_recordings_are_read_in_blocks(monkeypatch):
    whole = audio.chroma(*audio.blocks_of(sound(played(np.random.default_rng(3), 22_050), 22_050, "<i2")))
    for block in (1000, 7777):
        monkeypatch.setattr(audio, "BLOCK", block)
        got = audio.chroma(*audio.blocks_of(sound(played(np.random.default_rng(3), 22_050), 22_050, "<i2")))
        assert got.shape == whole.shape and np.allclose(got, whole, atol=1e-6)


def test_recall_of_noisy_cut_and_resampled_copies(spark):
    """At least 0.9 of such copies are aligned with what they are copies of, and of other recordings none."""
    rows, count = [], 50
    for i in range(count):
        dice = np.random.default_rng(i)
        clean = played(dice, audio.RATE)
        rows.append((50 * (i + 1), wav(clean)))
        start, noise = int(dice.integers(2000, 9000)), lambda size, dice=dice: dice.normal(0, 0.06, size)
        fast = played(np.random.default_rng(i), 22_050)
        at = int(dice.integers(11_000, 50_000))
        for j, copy in enumerate((wav(np.clip(clean + noise(len(clean)), -1, 1)), wav(np.clip(clean[start : start + 16_000] + noise(16_000), -1, 1)), sound(fast[at : at + 88_000], 22_050, "<f4"))):
            rows.append((100_000 + 3 * 50 * i + 3 * j + 1, copy))
        rows.append((200_000 + 50 * i + 7, wav(played(np.random.default_rng(900 + i), audio.RATE))))
    sounds = spark.createDataFrame(rows, "id long, sound binary")
    got = {r._id: r for r in audio.aligned(audio.fingerprints(sounds, id_col="id", sound_col="sound")).collect()}
    links = [got[50 * (i + 1)].n_links for i in range(count)]
    assert max(links) <= 3 and sum(links) >= 0.9 * 3 * count


def test_integral_image_equals_plain_sums():
    image = np.random.default_rng(0).random((40, 12))
    got, unsure = audio.codes(image)
    assert (np.bitwise_count(unsure) == audio.UNSURE).all()
    assert len(got) == 40 - audio.SPAN + 1
    bits, gaps = [], []
    for w in audio.WIDTHS:
        part, h = image[5 : 5 + w], w // 2
        for value in (part[:h].sum(), part[:, :6].sum(), part[:h, :6].sum() + part[h:, 6:].sum(), part[:, 3:9].sum()):
            ratio = np.log((1e-3 + value) / (1e-3 + part.sum() - value))
            level = int(np.digitize(ratio, audio.STEPS))
            bits.append(level ^ level >> 1)
            # the bit that is the other way beyond the nearest step
            gap, step = min((abs(ratio - s), s) for s in audio.STEPS)
            beyond = int(np.digitize(step + (1e-9 if ratio < step else -1e-9), audio.STEPS))
            gaps.append((gap, bits[-1] ^ beyond ^ beyond >> 1))
    want = 0
    for b in bits:
        want = want << 2 | b
    assert int(got[5]) == want
    least = sorted(range(16), key=lambda i: gaps[i][0])[: audio.UNSURE]
    assert int(unsure[5]) == sum(gaps[i][1] << 2 * (15 - i) for i in least)


def test_alignment_finds_copies_shifts_and_nothing_else(spark):
    dice = np.random.default_rng(1)
    base, tunes = tune(dice, 80), [tune(dice) for _ in range(20)]
    shifted = base[20 * audio.HOP :] + dice.normal(0, 0.003, len(base) - 20 * audio.HOP)
    rows = [(100, wav(base)), (1, wav(shifted)), (2, wav(base)), (50, None), (3, b"noise"), (4, wav(base[:500])), (None, wav(tunes[0], channels=2))]
    rows += [(10 + i, wav(t)) for i, t in enumerate(tunes)]
    sounds = spark.createDataFrame(rows, "id long, sound binary")
    got = {r._id: r for r in audio.aligned(audio.fingerprints(sounds, id_col="id", sound_col="sound")).collect()}
    assert len(got) == len(rows)
    assert got[2]._class == got[100]._class == 2
    assert (got[2].n_links, got[2].best_class, got[2].best_offset) == (1, 1, -20)
    assert got[2].best_errors < 0.1
    assert got[3].n_codes == got[4].n_codes == got[50].n_codes == 0 and got[50].n_links == 0
    assert got[11].best_class is None
    assert audio.aligned(audio.fingerprints(sounds.limit(0), id_col="id", sound_col="sound")).count() == 0


def test_noisy_copies_align_as_by_brute_force(spark):
    dice = np.random.default_rng(5)
    base = dice.integers(0, 1 << 32, 52)
    unsure = np.array([sum(1 << int(b) for b in dice.choice(32, audio.UNSURE, replace=False)) for _ in range(52)])
    rows = [(100, base.tolist())]
    for i in range(40):
        # 2 to 12 % of bits wrong, half of the unsure ones besides
        wrong = (dice.random((52, 32)) < 0.02 + 0.1 * i / 40) @ (1 << np.arange(32)) ^ unsure & dice.integers(0, 1 << 32, 52)
        rows.append((1 + i, (base ^ wrong)[i % 5 :].tolist()))
    rows.append((41, [int(x) ^ (i % 2) for i, x in enumerate(base)]))
    rows += [(60 + i, dice.integers(0, 1 << 32, 52).tolist()) for i in range(20)]
    rows = [(i, c, (unsure if i == 100 else dice.integers(0, 1 << 32, len(c))).tolist()) for i, c in rows]
    got = {r._id: r for r in audio.aligned(spark.createDataFrame(rows, "_id long, _codes array<long>, _unsure array<long>"), query_step=100).collect()}
    want = set()
    for name, other, _ in rows[1:]:
        for offset in range(-51, 52):
            x, y = base[max(0, -offset) :], np.array(other)[max(0, offset) :]
            size = min(len(x), len(y))
            differ = x[:size] ^ y[:size]
            sure = differ & ~unsure[max(0, -offset) :][:size]
            if (sure == 0).sum() >= 4 and np.bitwise_count(differ).sum() <= 0.2 * 32 * size:
                want.add(name)
                if name == 41 and offset == 0:
                    votes = int((sure == 0).sum())
    assert 41 in want and len(want) > 20
    assert got[100].n_links == len(want)
    assert (got[100].best_class, got[100].best_votes, got[100].best_offset) == (41, votes, 0)


def test_votes_are_the_same_in_parts():
    dice = np.random.default_rng(6)
    one, two = dice.integers(0, 6, 70), dice.integers(0, 6, 90)
    starts, starts2 = np.array([0, 0, 30, 70]), np.array([0, 40, 41, 41, 90])
    want = {}
    for i, j in ((i, j) for i in range(3) for j in range(4)):
        for x in range(starts[i], starts[i + 1]):
            for y in range(starts2[j], starts2[j + 1]):
                if one[x] == two[y]:
                    key = (i, j, int(y - starts2[j] - x + starts[i]))
                    want[key] = want.get(key, 0) + 1
    for at_once in (1, 50, 10**6):
        got = {tuple(x[:3]): x[3] for part in audio.offset_votes(one, starts, two, starts2, 3, at_once) for x in zip(*(c.tolist() for c in part), strict=True)}
        assert got == {k: n for k, n in want.items() if n >= 3}


def test_rendered_vectors_are_audible():
    blocks, rate = audio.blocks_of(audio.render([0.1, -0.2, None, 0.3] * 16))
    assert rate == audio.RATE and len(np.concatenate(list(blocks))) == 48 * audio.NOTE
    assert list(audio.blocks_of(audio.render(None))[0]) == []


def test_pipeline_stages(spark, tmp_path):
    words = [f"word{i}" for i in range(500)]
    dice = np.random.default_rng(2)
    text = lambda n: " ".join(dice.choice(words, n))
    rows = [(i, text(80), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[1][1] + " tail", "en", "s1", 1), (102, None, None, None, None)]
    rows += [(200 + i, text(30) + " idiot moron " + text(5), "en", "s0", 1) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 200)) for i, *_ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = [r.doc_id for r in docs.collect()]
    assert max(seen["toxicity"]) < 200 and len(seen["toxicity"]) >= 60
    assert 0 not in seen["exact_dedup"] and 100 in seen["exact_dedup"]
    assert 101 not in seen["simhash"] and 1 in seen["simhash"] and 102 in seen["simhash"]
    assert len(seen["mixing"]) > len(seen["simhash"])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(seen["mixing"])


def test_every_operator_is_registered():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 11)]
    assert set(registry.oracle_sql()) <= set(names)
