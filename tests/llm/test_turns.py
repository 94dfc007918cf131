from __future__ import annotations

import random
from datetime import datetime

import numpy as np
from plain_turns import all_turns
from pyspark.sql import functions as F

from voxlattice.llm import turns as T
from voxlattice.llm.boosting import Boosted

FILLERS, SOUNDS = ["э", "мм", "ну", "это самое", "ага"], ["смех", "смеётся", "лай собаки"]
HEADS = ["", "АБВ: ", "а. б. в.: ", "[ГДЕ]: ", "(ГДЕ) ", "**АБВ**: ", "AБB — ", "[00:01:02] ГДЕ. ", "Значит: "]
BODIES = ["Да, в лесу.", "Ну…", "Э-э-э, ммм", "(смех)", "[громко: смеётся]", "♪ лай собаки ♪ это самое", "[А где смех?]", "*смех* Нет", "00:00:01,000", "...", "(очень громко и долго смех)", "", "{СМЕЁТСЯ} ага-ага", "[(смех)]", "смех", "Нуу вот"]
TAGS = ["[SPEAKER_00]:", "Спикер 1:", "[SРЕАKER_02]:", "", None]


def tables(spark, seed: int):
    rng = random.Random(seed)
    at = lambda: datetime(2024, 1, rng.randrange(1, 28))
    srt = [{"recording_id": "r", "seg_file_no": rng.randrange(3), "srt_index": i, "start_code": "00:00:01,000", "end_code": None, "speaker_tag": rng.choice(TAGS), "text": rng.choice([None, *BODIES, "[speaker 1]: Да", "SPEAKER_00: ну"]), "loaded_at": at()} for i in range(60)]
    manual = [{"recording_id": "r", "seg_no": rng.randrange(3), "pos": i, "text": rng.choice(HEADS) + rng.choice(BODIES), "loaded_at": at()} for i in range(60)]
    s = spark.createDataFrame([tuple(r.values()) for r in srt], "recording_id string, seg_file_no int, srt_index int, start_code string, end_code string, speaker_tag string, text string, loaded_at timestamp")
    m = spark.createDataFrame([tuple(r.values()) for r in manual], "recording_id string, seg_no int, pos int, text string, loaded_at timestamp")
    return srt, manual, s, m


def test_turns_against_the_plain_version(spark):
    srt, manual, s, m = tables(spark, 1)
    catalog = spark.createDataFrame([("r", "АБВ, ГДЕ")], "recording_id string, speaker_codes string")
    doubled = s.unionByName(s).withColumn("speaker", F.lit("clash"))
    lines = T.srt_lines(doubled, FILLERS, SOUNDS).unionByName(T.manual_lines(m, catalog, FILLERS, SOUNDS))
    got = {(r.origin, r.recording_id, r.seg_no, r.speaker, r.first_pos, r.last_pos) for r in T.turns(lines).collect()}
    assert got == all_turns(srt, manual, {"r": ["АБВ", "ГДЕ"]}, FILLERS, SOUNDS)


def test_turns_of_empty_tables(spark):
    _, _, s, m = tables(spark, 2)
    catalog = spark.createDataFrame([], "recording_id string, speaker_codes string")
    lines = T.srt_lines(s.limit(0), [], []).unionByName(T.manual_lines(m.limit(0), catalog, [], []))
    assert T.turns(lines).collect() == []


def test_quick_test_agrees_with_the_whole_one():
    noise = T.Noise(FILLERS, SOUNDS)
    for body in [*BODIES, "«смех»", "вот", "ааага", "*[смех]*", "(да) смех (нет)", "дом (смех) ну", "(смех) ну дом"]:
        said = T.plain(body)
        assert not (noise.surely_speech(said) and noise.silent(said)), body


def test_very_long_blanks_and_signs_take_no_time():
    noise = T.Noise(FILLERS, SOUNDS)
    for body in (" " * 200_000, "[ " * 100_000, "- " * 100_000, "смех " * 50_000, "0" * 200_000, "ну" * 100_000):
        assert T.read_srt_line(None, "[" + body, noise)[0] is None
        T.read_manual_line({"абв": "АБВ"}, body, noise)


def constant(value: float):
    """Trees that say the same of every pair."""
    return lambda said, carried, rows: Boosted(T.FEATURES, rounds=0).fixed(value)


def test_the_trees_decide_where_turns_end(spark):
    """With a constant in their place, or blind to what is carried over lines left out, other turns come out."""
    rows = [("a", 0, 1, "[SPEAKER_00]:", "Да, в лесу."), ("a", 0, 2, "[SPEAKER_01]:", "(смех)"), ("a", 0, 3, None, "Нет, в поле."), ("a", 0, 4, "[SPEAKER_01]:", "Ещё в клети."), ("a", 0, 5, "[SPEAKER_00]:", "Вот и всё тут.")]
    s = spark.createDataFrame([(*r[:3], "00:00:01,000", "00:00:02,000", *r[3:], datetime(2024, 1, 1)) for r in rows], "recording_id string, seg_file_no int, srt_index int, start_code string, end_code string, speaker_tag string, text string, loaded_at timestamp")
    found = lambda **how: sorted((r.speaker, r.first_pos, r.last_pos) for r in T.turns(T.srt_lines(s, FILLERS, SOUNDS), **how).collect())
    right = [("SPEAKER_00", 1, 1), ("SPEAKER_00", 5, 5), ("SPEAKER_01", 3, 4)]
    assert found() == right
    assert found(model=constant(-99.0)) == [("SPEAKER_00", 1, 5)]
    assert len(found(model=constant(99.0))) == 4
    blind = lambda said, carried, n: Boosted(T.FEATURES).fit(np.array([[o, c, 0, 1, 0, 0, 0, 5] for o, c, _, _ in T.SETTLED] * 20), np.array([o * c for o, c, _, _ in T.SETTLED] * 20))
    assert found(model=blind) == [("SPEAKER_00", 1, 4), ("SPEAKER_00", 5, 5)]


def test_trees_of_the_test_tables_agree_with_held_out_lines(spark, tmp_path):
    """Fitted on one tenth of the lines, scored on all: the trees alone, without the comparison of speakers."""
    sf = "/root/testdata/sf0.01"
    fillers, sounds = T.noise_terms(spark.read.parquet(f"{sf}/noise_terms.parquet"))
    lines = T.srt_lines(spark.read.parquet(f"{sf}/srt_segments.parquet"), fillers, sounds)
    scanned = T._scanned(T.latest(lines, [*T.KEYS, "pos"], ["label", "speech", "asks", "words", "start_ms", "end_ms"])).persist()
    said, carried = scanned.where("speech"), T._carried(scanned)
    trees = T.fit_boundaries(said, carried, rows=700)
    pairs = T._pairs(said, carried).where("last_speaker IS NOT NULL").select((trees.column() > 0).alias("ends"), (F.col("speaker") != F.col("last_speaker")).alias("differ"))
    wrong = pairs.where("ends <> differ").count()
    scanned.unpersist()
    assert wrong == 0 and pairs.where("differ").count() > 1000


def test_hot_clip_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 5)
    rng = random.Random(3)
    srt = [{"recording_id": "r", "seg_file_no": 0, "srt_index": i, "start_code": None, "end_code": None, "speaker_tag": rng.choice([None] * 9 + ["[SPEAKER_00]:", "[SPEAKER_01]:"]), "text": rng.choice(["(смех)", "Да, в лесу.", "Ну…"]), "loaded_at": datetime(2024, 1, 1)} for i in range(-40, 200)]
    s = spark.createDataFrame([tuple(r.values()) for r in srt], "recording_id string, seg_file_no int, srt_index int, start_code string, end_code string, speaker_tag string, text string, loaded_at timestamp")
    got = {(r.origin, r.recording_id, r.seg_no, r.speaker, r.first_pos, r.last_pos) for r in T.turns(T.srt_lines(s, FILLERS, SOUNDS)).collect()}
    assert got == all_turns(srt, [], {}, FILLERS, SOUNDS)


def test_boosted_trees_learn_and_compile(spark):
    rng = np.random.default_rng(0)
    x = rng.random((800, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = Boosted(["a", "b"], rounds=30).fit(x, y)
    held = rng.random((300, 2))
    assert (((held[:, 0] > 0.5) ^ (held[:, 1] > 0.3)) == (model.score(held) > 0)).mean() > 0.95
    df = spark.createDataFrame(held[:50].tolist(), "a double, b double").select(model.column().alias("s"))
    assert np.allclose([r.s for r in df.collect()], model.score(held[:50]))
    assert Boosted(["a"]).fit(np.zeros((0, 1)), np.zeros(0)).trees == []
