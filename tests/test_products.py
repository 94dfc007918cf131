"""What the matching stages make, on worked examples and against row-by-row versions."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlattice.functions import similarity as S
from voxlattice.functions import text as T
from voxlattice.operators import batching, matching, products, reorder, segments
from voxlattice.plans import pipeline
from voxlattice.sources import audio, index, manifest, sinks
from voxlattice.sources.srt import MERGE, SPAN, parse_blocks

KEYS = ["k"]
FOUR = """1
00:00:00,571 --> 00:00:03,074
[SPEAKER_01]: Гораздо мягче.

2
00:00:03,154 --> 00:00:03,996
[SPEAKER_00]: А люди?

3
00:00:04,116 --> 00:00:06,779
[SPEAKER_01]: Люди?

4
00:00:06,819 --> 00:00:12,587
[SPEAKER_01]: Люди другие, обычаи другие.
"""
TOLD = "[А люди отличаются?] Лю\\ди други\\е. Обы\\чаи други\\е."


def test_four_blocks_and_a_transcript(spark):
    found = T.tokens(TOLD)
    said = ["Гораздо мягче.", "А люди?", "Люди?", "Люди другие, обычаи другие."]
    ends, costs = matching.span_boundaries([T.token_norm(x).split() for x in said], [n for _, n, _, _ in found], longest=20)
    assert ends == [0, 0, 3, 4, 6] and [round(c, 2) for c in costs] == [0.80, 1.06, 1.08, 1.32]
    blocks = parse_blocks(spark.createDataFrame([("r", FOUR)], "k string, srt string"), "srt", SPAN)
    merged = products.merged_spans(blocks, spark.createDataFrame([("r", TOLD)], "k string, transcript string"), KEYS, longest=20)
    assert products.merged_srt(merged, KEYS).first()["srt"] == (
        "1\n00:00:00,571 --> 00:00:03,074\n[SPEAKER_01]: Гораздо мягче.\n\n2\n00:00:03,154 --> 00:00:03,996\n[SPEAKER_00]: [А люди отличаются?]\n\n"
        "3\n00:00:04,116 --> 00:00:06,779\n[SPEAKER_01]: Лю\\ди\n\n4\n00:00:06,819 --> 00:00:12,587\n[SPEAKER_01]: други\\е. Обы\\чаи\n"
    )
    without = products.merged_spans(blocks, spark.createDataFrame([("x", TOLD)], "k string, transcript string"), KEYS)
    assert [(r.text, r.matched) for r in without.orderBy("srt_index").collect()] == [(x, False) for x in said]


def plain_composed(blocks, lines, matches):
    """Block by block: the text and the speaker in force."""
    out, last = {}, None
    for index, speaker, orig in sorted(blocks):
        taken = sorted(p for i, p in matches if i == index)
        if not taken:
            out[index] = "\n".join(orig)
            continue
        label, said = None, []
        for p in taken:
            line = lines[p]
            m = re.match(r"\[([A-Za-zА-Яа-яЁё.?]{1,8})\s*:(.*)", line, re.S)
            if m and not label:
                label, rest = f"[{m[1]}:]", m[2]
                inner, closed, tail = rest.partition("]")
                line = " ".join(x for x in (inner.strip(), tail.strip()) if x) if closed else rest.strip()
            line = line.strip()
            said.append(line[1:-1].strip() if line.startswith("[") and line.endswith("]") and len(line) > 2 else line)
        last = label or last or (f"[{speaker}]" if speaker else None)
        text = " ".join(x for x in said if x)
        out[index] = text if last is None else f"{last if ':' in last else last + ':'} {text}".strip()
    return out


def test_composed_blocks_against_the_plain_rule(spark):
    rng = random.Random(0)
    pool = ["[МВ:] Да.", "[Соб.: Вот, рассказывает.]", "[?:] [Как?]", "[смеётся]", "Нет, не так.", "[МВ: да", "[слишкомдлинно:] а", "[АБ:]", "[ДС :] тут [там] и"]
    blocks, lines, matches = [], [], []
    for k in range(12):
        size = rng.randrange(1, 9)
        blocks += [(f"c{k}", i, rng.choice([None, "SPEAKER_00", "SPEAKER_01"]), [f"[SPEAKER_00]: слово {i}", "ещё"][: rng.randrange(1, 3)]) for i in range(1, size)]
        lines += [(f"c{k}", p, rng.choice(pool)) for p in range(12)]
        free = iter(range(12))
        matches += [(f"c{k}", i, p) for i in range(1, size) for p in [next(free, None) for _ in range(rng.randrange(3))] if p is not None]
    b = spark.createDataFrame(blocks, "k string, srt_index int, speaker string, orig_lines array<string>")
    got = products.composed(b, spark.createDataFrame(lines, "k string, pos int, orig string"), spark.createDataFrame(matches, "k string, srt_index int, pos int"), KEYS)
    found = {(r.k, r.srt_index): r.new_text for r in got.collect()}
    want = {}
    for c in {x[0] for x in blocks}:
        made = plain_composed([x[1:] for x in blocks if x[0] == c], {p: t for k, p, t in lines if k == c}, [(i, p) for k, i, p in matches if k == c])
        want |= {(c, i): t for i, t in made.items()}
    assert found == want


def test_final_runs(spark):
    head = "1\n00:00:00,000 --> 00:00:01,000\n[SPEAKER_00]:"
    sources = spark.createDataFrame([("a", 0, f"{head} да"), ("a", 1, "без головы"), ("a", 2, "x"), ("b", 5, "одно"), ("b", 7, "два")], "k string, l_pos int, orig string")
    targets = spark.createDataFrame([("a", 0, "Да."), ("a", 1, "Вот.")], "k string, r_pos int, orig string")
    matches = spark.createDataFrame([("a", 0, 1), ("a", 0, 0), ("a", 2, 1)], "k string, l_pos int, r_pos int")
    got = {(r.k, r.l_pos): r.pieces for r in products.final_runs(sources, targets, matches, KEYS).collect()}
    assert got == {("a", 0): [head, "Да.", "Вот."], ("a", 1): ["без головы"], ("a", 2): ["Вот."], ("b", 5): ["одно"]}


def test_dialect_chain(spark):
    heard = spark.createDataFrame([("c", i, t) for i, t in enumerate(["А где жили вы?", "Мы жили у реки и ловили рыбу сетями всю зиму.", "Потом пошли в лес за грибами и ягодами."])] + [("n", 0, "да")], "k string, pos int, text string")
    made = spark.createDataFrame([("c", 0, "[А где жили вы?] Мы жи\\ли у реки́ и лови\\ли ры\\бу сетя\\ми всю зи\\му. Потом пошли\\ в лес за гриба\\ми и я\\годами.")], "k string, pos int, text string")
    texts, counts = products.dialect_texts(heard, made, KEYS, 0.6)
    assert counts.first().asDict() == {"k": "c", "whisper_total": 3, "whisper_dialect": 2, "whisper_standard": 1, "manual_total": 2, "manual_dialect": 1, "manual_standard": 1}
    pairs = products.dialect_pairs(texts, KEYS, 0.5)
    rows = pairs.orderBy("pair_no").collect()
    assert [r.pair_no for r in rows] == [1, 2] and all(r.kept for r in rows)
    assert rows[0].target == "Мы жи\\ли у реки́ и лови\\ли ры\\бу сетя\\ми всю зи\\му" and rows[0].source == "Мы жили у реки и ловили рыбу сетями всю зиму"
    done = products.chain_summary(counts, pairs, KEYS)
    r = done.first()
    assert (r.initial_pairs, r.final_pairs, r.chain_score, r.success) == (2, 2, 1.0, True) and r.mean_similarity > 0.5
    clips = spark.createDataFrame([("c", True, True), ("n", True, False), ("m", False, True)], "k string, has_srt boolean, has_text boolean")
    whole = products.with_errors(done, clips, KEYS)
    assert {x.k: (x.success, x.error) for x in whole.collect()} == {"c": (True, None), "n": (False, "no transcript"), "m": (False, "no recognised blocks")}
    assert products.outcome(whole).first()[:] == (3, 1, 2)


def test_first_originals_and_an_encoder_of_ones_own(spark):
    texts = spark.createDataFrame([("c", "Да вот так оно и было тут. Да́ вот так оно и было тут.", "Да вот так оно и было тут.")], "k string, whisper_text string, manual_text string")
    rows = products.dialect_pairs(texts, KEYS, 0.0, encoder=lambda: lambda ts: np.ones((len(ts), 2))).collect()
    assert {r.source for r in rows} == {"Да вот так оно и было тут"} and all(abs(r.sim - 1) < 1e-9 for r in rows)


def test_longest_rise():
    rng = random.Random(1)
    for _ in range(200):
        x = [rng.randrange(6) for _ in range(rng.randrange(8))]
        chosen = ([v for k, v in enumerate(x) if m >> k & 1] for m in range(1 << len(x)))
        best = max(len(y) for y in chosen if all(a < b for a, b in zip(y, y[1:])))
        at = products.longest_rise(x)
        assert len(at) == best and all(x[a] < x[b] for a, b in zip(at, at[1:]))


# ---- Stage 5.


def plain_similarity(texts, transcripts):
    grams = lambda t: [t[i : i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1)]
    docs = [grams(t) for t in [*texts, *transcripts]]
    df = {}
    for d in docs:
        for g in set(d):
            df[g] = df.get(g, 0) + 1
    rows = []
    for d in docs:
        v = {}
        for g in d:
            v[g] = v.get(g, 0) + np.log((1 + len(docs)) / (1 + df[g])) + 1
        size = sum(x * x for x in v.values()) ** 0.5
        rows.append({g: x / size for g, x in v.items()})
    a, b = rows[: len(texts)], rows[len(texts) :]
    return np.array([[0.7 * sum(x * v.get(g, 0.0) for g, x in u.items()) + 0.3 * S.token_set_ratio(s, t, blanks=True) / 100 for v, t in zip(b, transcripts)] for u, s in zip(a, texts)])


@pytest.mark.parametrize("side", [1, 256])
def test_reordering_by_active_rows_and_three_fits(spark, monkeypatch, side):
    monkeypatch.setattr(reorder, "SIDE", side)
    texts = ["рыбаки чинили сети у брода", "бабы носили корзины в амбар", "кузнецы точили косы на гумне", "дети пасли гусей за рекой"]
    # Numbers with holes; the first row isn't active but holds what the last active one needs.
    rows = [("f", 2, "", texts[3], False), ("f", 5, texts[0], texts[1], True), ("f", 9, texts[1], texts[2], True), ("f", 11, texts[2], texts[0], True), ("f", 20, texts[3], "нечто совсем иное", True), ("g", 1, "а", "б", False)]
    df = spark.createDataFrame(rows, "f string, pos int, text string, transcript string, active boolean")
    got, summary = reorder.reordered(df, "f", "pos", "text", "transcript", "active")
    found = sorted(((r.f, r.pos, r.transcript) for r in got.collect()), key=str)
    assert found == sorted([("f", 2, None), ("f", 5, texts[0]), ("f", 9, texts[1]), ("f", 11, texts[2]), ("f", 20, texts[3]), ("f", None, "нечто совсем иное"), ("g", 1, "б")], key=str)
    active = [r for r in rows if r[4]]
    before = plain_similarity([r[2] for r in active], [r[3] for r in active])
    diagonal = [np.mean([before[i, i + s] for i in range(len(active) - s)]) for s in range(4)]
    s = summary.collect()
    assert len(s) == 1 and s[0].applied and s[0].shift == int(np.argmax(diagonal))
    assert abs(s[0].mean_before - diagonal[0]) < 1e-9
    after = plain_similarity([r[2] for r in active], texts)
    assert abs(s[0].mean_after - np.mean(np.diag(after))) < 1e-9
    sim = reorder.matrix(df.where("active").select("f", F.lit(0).alias("side"), "pos", "text").unionByName(df.where("active").select("f", F.lit(1).alias("side"), "pos", F.col("transcript").alias("text"))), "f", "side", "pos", "text")
    place = {5: 0, 9: 1, 11: 2, 20: 3}
    assert all(abs(r.sim - before[place[r.i], place[r.j]]) < 1e-9 for r in sim.collect()) and sim.count() == 16


def test_order_is_kept_where_nothing_is_gained(spark):
    rows = [("f", i, t, t, True) for i, t in enumerate(["рыбаки чинили сети", "бабы носили корзины"])]
    got, summary = reorder.reordered(spark.createDataFrame(rows, "f string, pos int, text string, transcript string, active boolean"), "f", "pos", "text", "transcript", "active")
    assert sorted((r.pos, r.transcript) for r in got.collect()) == [(i, t) for _, i, t, _, _ in rows] and not summary.first().applied
    empty = spark.createDataFrame([], "f string, pos int, text string, transcript string, active boolean")
    assert reorder.reordered(empty, "f", "pos", "text", "transcript", "active")[0].collect() == []


# ---- Readers, scores and lists.


def test_the_merging_reader_passes_over_lines(spark):
    text = "шум\n5\n0:00:01,000 --> потом\n[SPEAKER_01]: Да\nвот\n\nx\nнет\n\n7\nбез стрелки\nA"
    rows = parse_blocks(spark.createDataFrame([("r", text)], "k string, srt string"), "srt", MERGE).collect()
    assert [(r.srt_index, r.start_code, r.end_code, r.speaker_tag, r.text) for r in rows] == [(5, "0:00:01,000", "потом", "SPEAKER_01", "Да вот")]


def test_scores_are_whole_numbers_in_one_matcher_and_words_go_by_blanks_in_the_other():
    assert S.token_set_ratio("кто-то", "кто то") == 100.0 and S.token_set_ratio("кто-то", "кто то", blanks=True) < 100
    assert S.token_set_ratio("Да", "да") == 100.0 and S.token_set_ratio("Да", "да", blanks=True) == 50.0
    a, b = "abcdefgh", "abcdefxyz"
    score = S.token_set_ratio(a, b)
    assert 70 < score < 71 and S.strict_scores(a, b)[0] == round(score)
    t = (round(score) - 1 + 0.0, 200)
    assert matching.greedy_run([a], [b], direct=(score - 0.2 if round(score) <= score - 0.2 else round(score), 200)) == [[]]
    assert matching.greedy_run([a], [b], direct=t) == [[0]]


def test_manifest_and_folder_are_united(spark, tmp_path):
    for name in ("a.webm", "b.WAV", "c.wma"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "list").write_text(f'{tmp_path}/b.WAV\n{{"path": "z.ogg"}}\n')
    got = manifest.discovered(spark, str(tmp_path / "list"), str(tmp_path)).orderBy("pos").collect()
    assert [r.path for r in got] == [f"{tmp_path}/b.WAV", "z.ogg", f"{tmp_path}/a.webm"]
    assert manifest.discovered(spark).collect() == []


def test_batches_in_a_drawn_order(spark):
    rows = [("r", i, 100.0) for i in range(20)]
    made = batching.duration_batches(spark.createDataFrame(rows, "k string, pos int, d double"), ["k"], "pos", "d")
    one, two, again = ({r.pos: r.turn for r in batching.shuffled(made, ["k"], seed).collect()} for seed in (1, 2, 1))
    assert one == again != two and sorted(one.values()) == list(range(20))


def test_long_lists_are_batched_in_a_stream(spark):
    rows = spark.range(60_000).select(F.lit("r").alias("k"), F.col("id").alias("pos"), (F.col("id") % 97 + 0.5).alias("d"))
    got = batching.duration_batches(rows, ["k"], "pos", "d")
    want = {}
    number = held = 0
    seconds, began = 0.0, False
    for d, p in sorted((i % 97 + 0.5, i) for i in range(60_000)):
        if began and (held >= 32 or seconds + d > 180):
            number, held, seconds = number + 1, 0, 0.0
        want[p] = (number, held)
        held, seconds, began = held + 1, seconds + d, True
    assert {r.pos: (r.batch_no, r.place) for r in got.collect()} == want


def test_texts_of_utterances_and_rows(spark, tmp_path):
    df = spark.createDataFrame([("r", 1, 3, "SPEAKER_00", "00:00:01.000", "Да\\ [смех] нет")], "k string, n int, srt_index int, speaker string, start_code string, text string")
    assert [(r.file, r.content) for r in sinks.utterance_texts(df, ["k"]).collect()] == [("003_SPEAKER_00_00-00-01-000_orig.txt", "Да\\ [смех] нет"), ("003_SPEAKER_00_00-00-01-000.txt", "Да нет")]
    sinks.write_texts(df, ["k", "n"], "text", str(tmp_path / "o"))
    assert [x.read_text() for x in (tmp_path / "o/k=r/n=1").glob("*.txt")] == ["Да\\ [смех] нет\n"]


def test_long_texts_are_cut_in_time_that_grows_with_them(spark):
    text = "Слово [да]. " * 60_000
    assert len(T.tokens(text)) == 120_000 and T.tokens("[Да]")[0][1] == "да"
    assert sum(len(x.split()) for x in T.pack(text)) == 120_000
    assert len(T.join_short(["да"] * 60_001)) == 30_001


def test_tokens_of_lines_keep_their_order(spark, tmp_path):
    df = spark.createDataFrame([("r", 1, 300_000, " ".join(f"с{i}" for i in range(20_000)), True), ("r", 1, 300_001, "конец", True)], "recording_id string, seg_no int, pos int, text string, is_dialect boolean").withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/manual_segments.parquet")
    spark.createDataFrame([], "recording_id string, seg_file_no int, srt_index int, start_code string, end_code string, speaker_tag string, text string, loaded_at timestamp").write.parquet(f"{tmp_path}/srt_segments.parquet")
    tokens = [r.r_norm for r in pipeline._token_sides(spark, str(tmp_path))[1].orderBy("r_pos").collect()]
    assert tokens == [f"с{i}" for i in range(20_000)] + ["конец"]


def test_parent_names(spark):
    df = spark.createDataFrame([("r", 0, None, "a"), ("r", 1, 0, "b"), ("r", 2, 7, "c")], "k string, n int, p int, name string")
    assert [r[:] for r in segments.parent_names(df, "k", "n", "p", "name").collect()] == [("r", 1, "a")]


def test_resampling_keeps_what_the_new_rate_can_hold():
    t = np.arange(44_100) / 44_100
    low, high = np.sin(2 * np.pi * 1_000 * t), np.sin(2 * np.pi * 12_000 * t)
    kept, gone = audio.mono(low, 44_100), audio.mono(high, 44_100)
    assert len(kept) == 16_000
    assert abs(np.sqrt(np.mean(kept[500:-500] ** 2)) - 0.5**0.5) < 0.01 and np.sqrt(np.mean(gone[500:-500] ** 2)) < 0.02


def test_files_are_reordered_or_copied(spark, tmp_path):
    texts = ["рыбаки чинили сети у брода", "бабы носили корзины в амбар", "кузнецы точили косы на гумне"]
    (tmp_path / "a.csv").write_text("name,text,transcript,trans\n" + "".join(f"n{i},{t},{texts[(i + 1) % 3]},yes\n" for i, t in enumerate(texts)))
    (tmp_path / "same.csv").write_text("text,transcript\n" + "".join(f"{t},{t}\n" for t in texts))
    (tmp_path / "odd.csv").write_text("text,other\nа,б\n")
    (tmp_path / "none.csv").write_text("text,transcript,trans\nа,б,no\n")
    (tmp_path / "bad.csv").write_text("text,transcript\nа,б,в,г\n")
    run = lambda name: reorder.reordered_file(spark, str(tmp_path / name), str(tmp_path / "out" / name))
    assert [run(f"{x}.csv") for x in ("a", "same", "odd", "none", "bad")] == ["reordered", "nothing is gained", "a column is missing", "no row counts", "unreadable"]
    for x in ("same", "odd", "none", "bad"):
        assert (tmp_path / f"out/{x}.csv").read_bytes() == (tmp_path / f"{x}.csv").read_bytes()
    rows = index.read_folder(spark, str(tmp_path / "out/a.csv"), "name string, text string, transcript string, trans string", "*.csv").collect()
    assert [(r.name, r.text, r.transcript, r.trans) for r in rows] == [(f"n{i}", t, t, "yes") for i, t in enumerate(texts)]


@pytest.mark.parametrize("letters", ["абв г", "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))])
def test_cosines_of_blocks_are_those_of_whole_files(spark, monkeypatch, letters):
    rng = random.Random(1)
    rows = [(f, s, p, "".join(rng.choices(letters[: 9000 // (p + 1)], k=rng.randrange(12)))) for f in ("f", "g") for s in (0, 1) for p in range(9)]
    # Many features in common, and the least frequent are dropped.
    docs = spark.createDataFrame(rows + [(f, s, p + 9, t[::-1] + t) for f, s, p, t in rows] + [("g", 1, 18, letters), *[(f, 0, 18, letters[500:520]) for f in "fg"]], "f string, side int, pos int, text string")
    monkeypatch.setattr(reorder, "FEATURES", 60)
    found = {}
    for block in (2048, 4):
        monkeypatch.setattr(reorder, "BLOCK", block)
        found[block] = {(r.f, r.i, r.j): round(r.cosine, 9) for r in reorder.matrix(docs, "f", "side", "pos", "text", words=False).collect()}
    assert found[4] == found[2048] and found[4]
    texts = {k: [[t for f, s, _, t in map(tuple, docs.collect()) if (f, s) == (k, x)] for x in (0, 1)] for k in "fg"}
    for k, (a, b) in texts.items():
        count = Counter(g for t in a + b for g in (t[p : p + n] for n in (3, 4, 5) for p in range(len(t) - n + 1)))
        least = sorted(count.values())[-60]
        shared = lambda x, y: any(count[g] >= least and g in y for g in (x[p : p + n] for n in (3, 4, 5) for p in range(len(x) - n + 1)))
        assert {(i, j) for f, i, j in found[4] if f == k} == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if shared(x, y)}


def test_assignment_of_columns_of_no_gain_that_are_not_held():
    rng = np.random.default_rng(4)
    for n, m, k in ((3, 5, 2), (6, 9, 4), (5, 5, 0), (7, 20, 20)):
        at = np.sort(rng.choice(m, k, replace=False))
        gain, whole = rng.integers(0, 4, (n, k)) / 4, np.zeros((n, m))
        whole[:, at] = gain
        assert reorder.assign(gain, at, m).tolist() == reorder.assign(whole).tolist()


def test_word_set_ratio_is_that_of_the_whole_texts():
    rng, words = random.Random(2), "а б вг дом сети рыбаки у".split()
    for _ in range(2000):
        x, y = ({*rng.choices(words, k=rng.randrange(1, 6))} for _ in range(2))
        both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
        one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
        want = 100.0 if both and not (left and right) else max(S.ratio(one, two), *((S.ratio(both, one), S.ratio(both, two)) if both else (0.0,)))
        assert S.word_set_ratio(x, y) == want


def test_packed_sims_are_those_of_the_matrix(spark, monkeypatch):
    rng = random.Random(6)
    docs = spark.createDataFrame([("f", s, 2 * p, " ".join(rng.choices("рыбаки чинили сети у брода".split(), k=rng.randrange(5)))) for s in (0, 1) for p in range(9)], "f string, side int, pos int, text string")
    want = {(r.i, r.j): r.sim for r in reorder.matrix(docs, "f", "side", "pos", "text").collect()}
    monkeypatch.setattr(reorder, "BLOCK", 4)
    found = {(i, j): r.sims[a * len(r.j) + b] for r in reorder.packed_matrix(docs, "f", "side", "pos", "text").collect() for a, i in enumerate(r.i) for b, j in enumerate(r.j)}
    assert set(found) == {(r.pos, q.pos) for r in docs.where("side = 0 AND text <> ''").collect() for q in docs.where("side = 1 AND text <> ''").collect()}
    assert all(abs(want[k] - found.get(k, 0.0)) < 1e-12 for k in want)


def test_packed_words_have_the_ratios_of_each_pair():
    rng, words = random.Random(3), "а б вг вгд дом сети рыбаки рыбачка у б, дым".split()
    for _ in range(300):
        sets = [{*rng.choices(words, k=rng.randrange(1, 9))} for _ in range(rng.randrange(1, 12))]
        packed = S.PackedWords(sets)
        for y in ({*rng.choices([*words, "зз", "яя"], k=rng.randrange(1, 12))} for _ in range(3)):
            assert packed.ratios(y).tolist() == [S.word_set_ratio(x, y) for x in sets]


def plain_assignment(gain: np.ndarray) -> float:
    """The greatest total by one row after another and all columns (Kuhn and Munkres)."""
    n, m = gain.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while match[j0]:
            used[j0], i0 = True, match[j0]
            for j in range(1, m + 1):
                if not used[j] and (slack := -gain[i0 - 1, j - 1] - u[i0] - v[j]) < least[j]:
                    least[j], way[j] = slack, j0
            j1 = min((j for j in range(1, m + 1) if not used[j]), key=lambda j: least[j])
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    return sum(gain[match[j] - 1, j - 1] for j in range(1, m + 1) if match[j])


def test_assignments_of_more_rows_than_columns_of_gain():
    rng = np.random.default_rng(5)
    for n, m, k in ((12, 30, 5), (12, 30, 12), (12, 30, 25), (20, 20, 13), (20, 20, 20), (9, 9, 1)):
        for gain in (rng.random((n, k)), rng.integers(0, 3, (n, k)) / 4):
            at, whole = np.sort(rng.choice(m, k, replace=False)), np.zeros((n, m))
            whole[:, at] = gain
            got = reorder.assign(gain, at, m)
            assert len(set(got.tolist())) == n and abs(whole[np.arange(n), got].sum() - plain_assignment(whole)) < 1e-9


def test_large_matrices_are_assigned_in_seconds():
    # 2,000 rows for 1,100 columns took over 150 s on a slow machine as long as paths began at the rows and ran through columns without gain.
    gain = np.random.default_rng(6).random((2000, 1100))
    began = time.thread_time()
    got = reorder.assign(gain, np.arange(1100), 4000)
    assert len(set(got.tolist())) == 2000 and {*range(1100)} <= set(got.tolist()) and time.thread_time() - began < 20


def test_sims_take_five_bytes():
    sims = np.array([0.0, 1.0, 1 / 3, 1e-12, 0.123456789012])
    assert len(reorder.to_bytes(sims)) == 25 and reorder.from_bytes(reorder.to_bytes(sims)).tolist() == np.round(sims, 12).tolist()
