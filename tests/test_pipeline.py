"""The corpus pipeline's operators on small cases."""

from __future__ import annotations

import itertools
import random
import zipfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlattice.functions import similarity as S
from voxlattice.functions import text as T
from voxlattice.functions.timecode import code_ms, code_seconds, ms_code
from voxlattice.operators import batching, matching, recognise, reorder, segments
from voxlattice.sources import audio, index, manifest, sinks
from voxlattice.sources.srt import CUT, EMBED, MERGE, SPAN, parse_blocks, render_srt
from voxlattice.streaming.srt_stream import each_batch, stream_blocks


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def test_time_codes(spark):
    assert one(spark, code_ms, " 00 : 01:02 , 345\t") == 62_345
    assert [one(spark, code_ms, x) for x in ("00:61:00,000", "нет", "", None, "00:00:01,00")] == [None] * 5
    assert one(spark, code_seconds, "00:00:01.500") == 1.5
    assert one(spark, ms_code, 3_723_004, "bigint") == "01:02:03,004"


def test_normalisers(spark):
    said = "[Соб. 1] Э\\то са́мое_, Ёлка — да… Ну-ка! 00:01:02,003"
    assert one(spark, T.norm_reorder, said).startswith("это са́мое ёлка — да… ну ка")
    assert one(spark, T.norm_edit, said).endswith("ёлка да… ну ка 00 01 02 003")
    assert one(spark, T.norm_tokens, "Мой «чай», ёж-то") == "мои чаи еж-то"
    assert one(spark, lambda c: T.norm_match(c, srt=True), "[x] Да, (нет)…") == "да нет"
    assert one(spark, T.clean_for_matching, "Да_,  нет́ ") == "Да, нет"
    assert one(spark, T.clean_without_notes, "Да [смех] нет") == "Да нет"


def test_brackets_labels_and_packing(spark):
    parts = one(spark, T.bracket_parts, "[Как?] А, ну. [Соб. смех] Тут […] [ Где? ]")
    assert [(p.text, p.is_dialect) for p in parts] == [("Как?", False), ("А, ну.", True), ("Тут", True), ("Где?", False)]
    found = one(spark, T.prepared_segments, "[мв:] Да. Нет! [Где?]")
    assert [x.orig for x in found] == ["[мв:] Да.", "Нет!", "[Где?]"]
    assert one(spark, T.label_of, "[мв: да]") == "мв:"
    assert one(spark, T.without_label, "[мв: да] нет") == "да нет"
    assert one(spark, T.packed_sentences, "Раз два. Три четыре пять шесть. Семь!") == ["Раз два Три четыре пять шесть", "Семь"]
    joined = one(spark, T.joined_short, ["да", "раз два три", "нет"], "array<string>")
    assert [x.orig for x in joined] == ["да раз два три", "нет"]
    assert [(t.text, t.start, t.end) for t in one(spark, T.tokens_with_offsets, " аб  в г")] == [("аб", 1, 3), ("в", 5, 6), ("г", 7, 8)]
    assert one(spark, T.tokens_with_offsets, "") == []


def test_index_lines(spark):
    assert one(spark, T.time_code, "00:00:01,000 – Да") == "00:00:01.000"
    assert one(spark, T.time_code, "00:00:01,000— Да") is None
    assert one(spark, T.continuation_code, "00:00:01,000 – Да. Продолжение: 00:02:39,900).") == "00:02:39.900"
    assert [one(spark, T.tolerant_bool, x) for x in ("TRUE", "1", " yes", "2", "0", "no", "abc", None)] == [True] * 4 + [False] * 4


def test_similarities(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"], [1.0, 0.0], [1.0, 1.0], "кот", "рот")], "a array<string>, b array<string>, u array<double>, v array<double>, s string, t string")
    r = df.select(S.dice(F.col("a"), F.col("b")), S.cosine(F.col("u"), F.col("v")), S.edit_similarity(F.col("s"), F.col("t"))).first()
    assert r[0] == 0.5 and abs(r[1] - 2**-0.5) < 1e-12 and abs(r[2] - 2 / 3) < 1e-12
    rng = random.Random(2)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(n))) for n in (9, 20))
        short, long_ = sorted((a, b), key=len)
        want = max((S.ratio(short, long_[max(0, i) : i + len(short)]) for i in range(-len(short) + 1, len(long_))), default=0.0) if short else (0.0 if long_ else 100.0)
        assert abs(S.partial_ratio(a, b) - want) < 1e-9
    assert S.token_set_ratio("a b", "b a c") == 100.0 and S.token_set_ratio("", "a") == 0.0


BLOCKS = "1\n00:00:00,031 --> 00:00:05,739\n[SPEAKER_01]: Да\nвот\n\n2\n00:00:05,759 --> 00:00:16,675\nНет\n\nx\n00:00:01,000 --> 00:00:02,000\nA\n\n4\n00:00 --> 1\nB\n"


def test_srt_readers(spark):
    df = spark.createDataFrame([("r", BLOCKS), ("e", ""), ("n", None)], "k string, srt string")
    read = lambda rules: [(r.srt_index, r.start_code, r.speaker_tag, r.text) for r in parse_blocks(df, "srt", rules).orderBy("block_no").collect()]
    # The merging reader takes whatever stands on both sides of the arrow.
    assert read(MERGE) == [(1, "00:00:00,031", "SPEAKER_01", "Да вот"), (2, "00:00:05,759", None, "Нет"), (4, "00:00", None, "B")]
    assert read(SPAN) == [(1, "00:00:00,031", "[SPEAKER_01]:", "Да\nвот"), (2, "00:00:05,759", "", "Нет")]
    assert read(EMBED) == [(1, "00:00:00,031", "SPEAKER_01", "Да"), (2, "00:00:05,759", "UNKNOWN", "Нет"), (None, "00:00:01,000", "UNKNOWN", "A")]
    strict = parse_blocks(df, "srt", CUT).orderBy("block_no").collect()
    assert [r.bad for r in strict] == [None, None, "index", "time"] and strict[0].start_code == "00:00:00.031"


def test_srt_round_trip_and_stream(spark, tmp_path):
    rows = [("r", 7, i, f"00:00:0{i},000", f"00:00:0{i},500", "[SPEAKER_00]:", f"т{i}") for i in range(1, 5)]
    df = spark.createDataFrame(rows, "recording_id string, seg_no int, srt_index int, start_code string, end_code string, speaker_tag string, text string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/rNo7.srt").write_text(render_srt(df, ["recording_id", "seg_no"], "srt_index").first()["srt"] + "\n")
    got = []
    each_batch(stream_blocks(spark, str(tmp_path / "in"), SPAN), lambda b, _: got.extend(b.collect()), str(tmp_path / "ck")).awaitTermination()
    assert sorted(tuple(r[c] for c in df.columns) for r in got) == rows


def test_links_and_chains(spark):
    rows = [("r", 0, "a", "c", "t0"), ("r", 1, "b", None, "t1"), ("r", 2, "c", "e", "t2"), ("r", 3, "c", "d", "t3"), ("r", 4, "e", None, None), ("r", 5, "d", "d", "t5")]
    df = spark.createDataFrame(rows, "recording_id string, seg_no int, start string, cont string, text string")
    linked = segments.link_continuations(df, "recording_id", "seg_no", "start", "cont")
    assert {r.seg_no: r.prev for r in linked.collect()} == {0: None, 1: None, 2: 0, 3: 0, 4: 2, 5: 5}
    merged = {r.seg_no: (r.text, r.members) for r in segments.merged_chains(linked, "recording_id", "seg_no", "prev", "text").collect()}
    assert merged == {0: ("t0 t2 t3 ", "0,2,3,4"), 1: ("t1", "1"), 5: ("t5", "5")}


def test_zip_join(spark):
    left = spark.createDataFrame([("r", 1), ("r", 2), ("s", 1)], "k string, a int")
    right = spark.createDataFrame([("r", "x"), ("s", "y"), ("s", "z")], "k string, t string")
    got = segments.zip_join(left, right, ["k"], [F.col("a")], [F.col("t")], ["t"])
    assert sorted(map(tuple, got.collect()), key=str) == [("r", 1, "x"), ("r", 2, None), ("s", 1, "y")]
    assert [tuple(r) for r in segments.unzipped(left, right, ["k"]).collect()] == [("s", 1)]


def test_filled_speakers(spark):
    rows = [("r", 1, None, None), ("r", 2, None, "p1"), ("r", 3, None, "p2"), ("r", 4, "E", None), ("r", 5, None, "p3")]
    got = segments.filled_speakers(spark.createDataFrame(rows, "k string, o int, e string, p string"), ["k"], "o", "e", "p")
    assert [r.speaker for r in got.orderBy("o").collect()] == [None, "p1", "p1", "E", "E"]


def test_merged_labels(spark):
    df = spark.createDataFrame([("r", 1, "[a:]"), ("r", 2, "[b:]"), ("r", 3, "да"), ("r", 4, "нет")], "k string, o int, t string")
    got = segments.merged_labels(df, ["k"], "o", "t", F.col("t").startswith("["))
    assert [r.t for r in got.orderBy("o").collect()] == ["[a:]", "[b:] да", "нет"]


def test_greedy_matchers():
    a = ["один два три", "четыре пять", "шесть семь"]
    assert matching.greedy_pointer(a, a) == [[0], [1], [2]]
    assert matching.greedy_pointer(["совсем другое", *a], ["лишнее слово тут", *a])[1:] == [[1], [2], [3]]
    assert matching.greedy_run(a, a)[0] == [0] and matching.greedy_run(a, []) == [[], [], []]
    assert matching.greedy_run(["а б"], ["а б"]) == [[0]]


def brute_spans(segs, tokens, skip, least, longest, cost):
    best = (float("inf"), None)

    def go(i, j, total):
        nonlocal best
        if i == len(segs):
            best = min(best, (round(total, 9), j))
            return
        go(i + 1, j, total + skip)
        for k in range(1, min(longest, len(tokens) - j) + 1):
            a, b = set(segs[i]), set(tokens[j : j + k])
            sim = 2 * len(a & b) / (len(a) + len(b)) if a and b else 0
            if sim >= least:
                go(i + 1, j + k, total + 1 - sim + cost * k)

    go(0, 0, 0.0)
    return best


def test_span_matches_against_all_paths():
    rng = random.Random(4)
    for _ in range(60):
        segs = [[rng.choice("abcd") for _ in range(rng.randrange(3))] for _ in range(rng.randrange(4))]
        tokens = [rng.choice("abcd") for _ in range(rng.randrange(6))]
        ends, costs = matching.span_boundaries(segs, tokens, longest=3)
        want, j = brute_spans(segs, tokens, 0.8, 0.3, 3, 0.02)
        assert round(costs[-1] if costs else 0.0, 9) == want and ends[-1] == j and ends[0] == 0 and ends == sorted(ends)


def test_assignment_against_all():
    rng = np.random.default_rng(0)
    for n, m in ((1, 1), (3, 3), (3, 5), (5, 5)):
        gain = rng.random((n, m))
        got = reorder.assign(gain)
        assert len(set(got)) == n
        best = max(sum(gain[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(m), n))
        assert abs(gain[np.arange(n), got].sum() - best) < 1e-9


def test_reordering(spark):
    texts = ["рыбаки чинили сети у брода", "бабы носили корзины в амбар", "кузнецы точили косы на гумне"]
    rows = [("f", i, t, texts[(i + 1) % 3], True) for i, t in enumerate(texts)] + [("f", 3, "", None, False)]
    df = spark.createDataFrame(rows, "f string, pos int, text string, transcript string, active boolean")
    rows, summary = reorder.reordered(df, "f", "pos", "text", "transcript", "active")
    assert {r.pos: r.transcript for r in rows.collect()} == {0: texts[0], 1: texts[1], 2: texts[2], 3: None}
    assert summary.first().applied


def test_batches(spark):
    rows = [("r", i, d) for i, d in enumerate([5.0, 1.0, 400.0, 1.0, 100.0, 90.0])] + [("r", 9, None)]
    got = batching.duration_batches(spark.createDataFrame(rows, "k string, pos int, d double"), ["k"], "pos", "d", 3, 180.0)
    assert [(r.pos, r.batch_no, r.place) for r in got.orderBy("batch_no", "place").collect()] == [(1, 0, 0), (3, 0, 1), (0, 0, 2), (5, 1, 0), (4, 2, 0), (2, 3, 0)]
    assert one(spark, lambda c: batching.mask(c, F.lit(3)), [1.0, 2.0], "array<double>") == [True, True, False]
    assert one(spark, lambda c: batching.padded(c, F.lit(3)), [1.0], "array<double>") == [1.0, 0.0, 0.0]
    assert one(spark, lambda c: batching.ctc_text(c, F.array(*map(F.lit, "_ab"))), [0, 1, 1, 0, 1, 2, 2], "array<int>") == "aab"


def test_first_seen_and_band(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, o int, v string")
    assert sorted(map(tuple, segments.first_seen(df, ["k"], "o").collect())) == [("a", 1, "y"), ("b", 3, None)]
    v = spark.createDataFrame([("g", i, [float(i)]) for i in range(30)], "g string, p int, e array<double>")
    got = {(r.i, r.j) for r in segments.banded_pairs(v, "g", "p", "e", v, 3).collect()}
    assert got == {(i, j) for i in range(30) for j in range(30) if abs(i - j) <= 3}


def test_manifest_and_tables(spark, tmp_path):
    (tmp_path / "m").write_text('a.wav\n\n{"path": "b.wav"}\n{"path": ""}\nnot {json\na.wav\n')
    got = manifest.read_manifest(spark, str(tmp_path / "m"))
    assert [r.path for r in got.orderBy("pos").collect()] == ["a.wav", "b.wav", "not {json"]
    df = spark.createDataFrame([("а\n\"б\", в", 1), (None, 2)], "t string, n int")
    sinks.write_results(df, str(tmp_path / "o.csv"))
    back = index.read_table_file(spark, str(tmp_path / "o.csv"), "t string, n int")
    assert {(r.t, r.n) for r in back.collect()} == {("а\n\"б\", в", 1), (None, 2)}
    sinks.write_results(df, str(tmp_path / "o.jsonl"))
    assert {(r.t, r.n) for r in spark.read.schema("t string, n int").json(str(tmp_path / "o.jsonl")).collect()} == {("а\n\"б\", в", 1), (None, 2)}
    with pytest.raises(ValueError):
        sinks.write_results(df, str(tmp_path / "o.txt"))


def test_index_files(spark, tmp_path):
    (tmp_path / "r.txt").write_text("﻿head\n\n00:00:01,000 – Да.\nnone\n00:00:02,000 – Нет. НЕ РАСПИСАНО\n")
    parsed = index.parse_index(index.text_lines(spark, str(tmp_path)))
    assert [(r.seg_no, r.start, r.trans, r.name) for r in parsed.orderBy("seg_no").collect()] == [(0, "00:00:01.000", True, "rNo0.wav"), (1, "00:00:02.000", False, "rNo1.wav")]
    xml = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>00:00:01,000 – </w:t><w:t>Да</w:t></w:p><w:p/></w:document>'
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", xml)
    (tmp_path / "bad.docx").write_bytes(b"no")
    got = index.docx_lines(spark, str(tmp_path)).orderBy("recording_id", "line_no").collect()
    assert [(r.recording_id, r.line_no, r.line, r._error) for r in got] == [("bad", None, None, "not an archive"), ("d", 0, "00:00:01,000 – Да", None), ("d", 1, "", None)]
    rec = spark.createDataFrame([(1, "n\nd\nA, B\nраз\nдва\nC\n\nn\nd\nA\nC, D")], "k int, v string")
    got = index.transcript_records(rec, "k", "v").orderBy("id").collect()
    assert [(r.id, r.transcript, r.max_speakers, r.min_speakers) for r in got] == [(1, "раз два", 3, 1), (2, "", 3, 2)]


def test_audio(spark, tmp_path):
    tone = 0.5 * np.sin(np.arange(8000) * 2 * np.pi * 440 / 8000)
    (tmp_path / "t.wav").write_bytes(audio.encode(np.column_stack([tone, tone]), 8000))
    (tmp_path / "s.WAV").write_bytes(audio.encode(np.zeros(800), 8000))
    (tmp_path / "b.wav").write_bytes(b"nothing")
    got = {Path(r.path).name: r for r in audio.scan_audio(spark, str(tmp_path)).collect()}
    assert got["t.wav"].channels == 2 and got["t.wav"].duration_s == 1.0 and abs(got["t.wav"].mean_volume_db + 9.03) < 0.05
    assert got["s.WAV"].mean_volume_db is None and got["b.wav"]._error
    files = audio._files(spark, str(tmp_path)).where("path LIKE '%t.wav'")
    x, rate = audio.decode(bytes(audio.converted(files).first()["wav"]))
    assert rate == 16000 and x.shape == (16000, 1)
    plan = files.select("path", F.explode(F.array(F.struct(F.lit("a").alias("name"), F.lit(0).alias("start_ms"), F.lit(250).alias("end_ms")), F.struct(F.lit("b").alias("name"), F.lit(250).alias("start_ms"), F.lit(None).cast("int").alias("end_ms")))).alias("c")).select("path", "c.*")
    clips = audio.cut(files, plan)
    sizes = {r["name"]: len(audio.decode(bytes(r.wav))[0]) for r in clips.collect()}
    assert sizes == {"a": 2000, "b": 6000}
    whole = audio.joined(clips.withColumn("k", F.lit(1)), "k", "name").first()["wav"]
    assert len(audio.decode(bytes(whole))[0]) == 8000
    assert manifest.find_audio(spark, str(tmp_path)).count() == 3
    clips = files.select(F.lit(0).alias("pos"), "path", F.lit(1.0).alias("duration_s"), "content")
    said = recognise.recognise(clips, recognise.Loudness, recognise.Settings("none", "stub")).first()
    assert said["text"].startswith("16000 samples") and said.model_type == "stub"
    with pytest.raises(ValueError):
        recognise.Settings("m", "t", dtype="int8").checked()


def test_stages_are_written_once_and_released(spark):
    from voxlattice import runtime

    kept = runtime.stage(spark.range(5).toDF("x"))
    gone = runtime.stage(spark.range(5).toDF("x"))
    runtime.drop_stage(gone)
    assert kept.count() == 5 and gone._voxlattice_path not in runtime._STAGED
    runtime.release(spark)
    assert runtime._STAGED == []
    assert runtime.fresh(kept, "x", "y", "Y") == ["_x", "y", "_Y"]
    assert runtime.broadcast_if_small(spark.range(9).toDF("x"), 3).count() == 9
