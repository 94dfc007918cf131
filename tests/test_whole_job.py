"""Cases in which a shorter way once gave less than the whole result."""

from __future__ import annotations

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxlattice.functions.timecode import code_ms
from voxlattice.operators import hierarchy, matching
from voxlattice.operators.whole_keys import begins, whole_keys
from voxlattice.plans import pipeline
from voxlattice.plans.queries import QUERIES


def test_codes_that_end_in_a_line_break(spark):
    codes = ["00:00:01,345\n", "00:00:01.345\r\n", "00:00:01,345\u2003", "00:00:01,345", "\n00:00:01,345", "00:00:01,34\n5", "00:00:01,34\n", "00:00:61,345\n"]
    df = spark.createDataFrame(list(enumerate(codes)), "i int, x string")
    assert [r.y for r in df.select("i", code_ms(F.col("x")).alias("y")).orderBy("i").collect()] == [1345] * 6 + [None] * 2


def saved(spark, folder, **tables):
    """The tables as queries read them."""
    for name, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


SRT = "recording_id string, seg_file_no int, srt_index int, start_code string, end_code string, speaker_tag string, text string"
MANUAL = "recording_id string, seg_no int, pos int, text string, is_dialect boolean"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_matches_of_all_lines_against_brute_force(spark, tmp_path):
    made = ["они пошли « домой »", "♪ песня", "кафе\u0301 утро\u0306", "вот так", "naïve word", "да", ""]
    heard = ["они пошли домой", "они пошли « домой", "♪ песня ♪", "песня", "кафе утро\u0306", "вот так", "naïve words", "да ☺", None]
    sf = saved(spark, tmp_path, manual_segments=([("r", 1, i, x, True) for i, x in enumerate(made)], MANUAL), srt_segments=([("r", 1, i, None, None, None, x) for i, x in enumerate(heard)], SRT))
    a, b = pipeline._sides(spark, sf)
    left, right = {r.l_pos: r.l_norm for r in a.collect()}, {r.r_pos: r.r_norm for r in b.collect()}
    want = {}
    for i, x in left.items():
        sim, j = max((1 - edits(x, y) / max(len(x), len(y)), -j) for j, y in right.items())
        if sim >= 0.5:
            want[i] = (-j, round(sim, 9))
    got = {r.l_pos: (r.r_pos, r.sim) for r in pipeline.edit_matches(spark, sf).collect()}
    assert got == want and len(got) == 6


def test_a_clip_is_aligned_across_any_place(spark):
    """Long before 2,000 segments the old parts lost what lay across their border, and counted tokens from it."""
    n = 2_100
    tokens = [("r", 1, i, f"слово{i}") for i in range(n + 300)]
    lines = [("r", 1, i, f"слово{i + 300}" if i >= 1_000 else "нет") for i in range(n)]
    left, right = spark.createDataFrame(lines, "recording_id string, seg_no int, l_pos int, l_norm string"), spark.createDataFrame(tokens, "recording_id string, seg_no int, r_pos int, r_norm string")
    tail = spark.createDataFrame([("r", 1, i, f"слово{i}") for i in range(n)], "recording_id string, seg_no int, l_pos int, l_norm string")
    rows = matching.span_aligned(tail, right.where(f"r_pos < {n}"), ["recording_id", "seg_no"]).orderBy("l_pos").collect()
    assert [(r.tok_from, r.tok_to) for r in rows] == [(i, i + 1) for i in range(n)]
    met = matching.aligned(tail, right, ["recording_id", "seg_no"], lambda a, b: [[b.index(x)] if x in b else [] for x in a]).collect()
    assert sorted((r.l_pos, r.r_pos) for r in met) == [(i, i) for i in range(n)]
    far = matching.aligned(left, right, ["recording_id", "seg_no"], lambda a, b: [[b.index(x)] if x in b else [] for x in a]).collect()
    assert sorted((r.l_pos, r.r_pos) for r in far) == [(i, i + 300) for i in range(1_000, n)]


def plain_boundaries(segments, tokens, skip, least, longest, length_cost):
    """The whole table, as the reference fills it."""
    n, m = len(segments), len(tokens)
    best, came = [[float("inf")] * (m + 1) for _ in range(n + 1)], [[0] * (m + 1) for _ in range(n + 1)]
    best[0][0] = 0.0
    for i in range(1, n + 1):
        own = set(segments[i - 1])
        for j in range(m + 1):
            best[i][j], came[i][j] = best[i - 1][j] + skip, j
            for k in range(1, min(longest, j) + 1):
                seen = set(tokens[j - k : j])
                similar = 2 * len(own & seen) / (len(own) + len(seen))
                if own and similar >= least and (total := best[i - 1][j - k] + ((1 - similar) + length_cost * k)) < best[i][j]:
                    best[i][j], came[i][j] = total, j - k
    ends = [min(range(m + 1), key=lambda j: best[n][j])]
    for i in range(n, 0, -1):
        ends.append(came[i][ends[-1]])
    ends.reverse()
    return ends, [best[i][ends[i]] for i in range(1, n + 1)]


@pytest.mark.parametrize("whole", [0, matching.WHOLE_TABLE])
def test_span_boundaries_equal_the_whole_table(monkeypatch, whole):
    monkeypatch.setattr(matching, "WHOLE_TABLE", whole)
    rng = random.Random(7)
    for _ in range(150):
        segments = [[rng.choice("abcdefg") for _ in range(rng.randrange(5))] for _ in range(rng.randrange(12))]
        tokens = [rng.choice(["", *"abcdefgh"]) for _ in range(rng.randrange(30))]
        options = {"skip": rng.choice([0.5, 0.8, 1.0]), "least": rng.choice([0.2, 0.3, 0.4]), "longest": rng.choice([3, 15, 25]), "length_cost": rng.choice([0.01, 0.02, 0.05])}
        assert matching.span_boundaries(segments, tokens, **options) == plain_boundaries(segments, tokens, **options)


def test_readers_return_all_blocks_of_a_clip(spark, tmp_path):
    rows = [
        ("r", 1, 1, "00:00:01,000", "00:00:02,000", "[SPEAKER_01]:", "да"), ("r", 1, 2, "00:00:02,000", "00:00:03,000", None, "без метки"), ("r", 1, 3, "0:00:03,000", "00:00:04,000", "[SPEAKER_01]:", "код"),
        ("r", 1, 4, None, "00:00:05,000", "[SPEAKER_01]:", "нет кода"), ("r", 1, 5, "00:00:05,000", "00:00:06,000", "", None), ("r", 1, 6, "00:00:06,000", "00:00:07,000", " ", "[АБВ]: да"),
    ]
    sf = saved(spark, tmp_path, srt_segments=(rows, SRT))
    read = lambda name: [(r.srt_index, r.tag, r.bad) for r in QUERIES[name](spark, sf).orderBy("block_no").collect()]
    assert [r for r in read("srt_parse_merge") if r[2] is None] == [(1, "SPEAKER_01", None), (2, None, None), (3, "SPEAKER_01", None), (5, None, None), (6, None, None)]
    assert [(i, b) for i, _, b in read("srt_parse_merge") if b] == [(4, "time")]
    assert [r for r in read("srt_parse_span") if r[2] is None] == [(1, "[SPEAKER_01]:", None), (2, "", None), (5, "", None), (6, "[АБВ]:", None)]
    for name, last in (("srt_parse_embed", "UNKNOWN"), ("srt_parse_cut", "АБВ")):
        got = read(name)
        assert [r for r in got if r[2] is None] == [(1, "SPEAKER_01", None), (2, "UNKNOWN", None), (6, last, None)]
        assert {i: b for i, _, b in got if b} == {3: "time", 4: "lines", 5: "lines"}


def test_descendants_on_and_below_circles(spark):
    rng = random.Random(5)
    parents = {(g, v): rng.choice([None, rng.randrange(60), rng.randrange(60), v if v % 20 == 7 else 3]) for g in ("a", "b") for v in range(60)}
    parents |= {("c", v): v - 1 if v else 4 for v in range(45)} | {("d", v): (v + 1) % 9 for v in range(9)} | {("a", 0): 1, ("a", 1): 2, ("a", 2): 0}
    tree = hierarchy.hierarchy(spark.createDataFrame([(g, v, p) for (g, v), p in parents.items()], "g string, v int, p int"), "g", "v", "p")
    ups = {}
    for g, v in parents:
        seen, at = set(), parents[g, v]
        while at is not None and at not in seen:
            seen.add(at)
            at = parents[g, at]
        ups[g, v] = seen
    pairs = [(r.g, r.v, r.descendant) for r in hierarchy.descendants(tree, "g", "v", circles=True).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(g, a, v) for (g, v), seen in ups.items() for a in seen if a != v}
    rows = hierarchy.whole_sizes(tree, "g").collect()
    assert {(r.g, r.v) for r in rows if r.circle is not None} == {(g, v) for (g, v), seen in ups.items() if v in seen}
    assert {(r.g, r.v): r.size - 1 for r in rows} == {(g, a): sum(1 for h, x, _ in pairs if (h, x) == (g, a)) for g, a in parents}


def test_best_parameters_of_the_whole_grid(spark, tmp_path):
    heard = ["один а б в г д е ж", "два три", "нет"]
    sf = saved(spark, tmp_path, manual_segments=([("r", 1, 0, "один и к два три", True)], MANUAL), srt_segments=([("r", 1, i, None, None, None, x) for i, x in enumerate(heard)], SRT))
    left, right = pipeline._token_sides(spark, sf)
    segments = [r.l_norm.split() for r in left.orderBy("l_pos").collect()]
    tokens = [r.r_norm for r in right.orderBy("r_pos").collect()]
    scores = []
    for s, t, c in itertools.product((0.5, 0.8, 1.0), (0.2, 0.3, 0.4), (0.01, 0.02, 0.05)):
        ends, _ = plain_boundaries(segments, tokens, s, t, 15, c)
        scores.append((sum(a == b for a, b in zip(ends, ends[1:])), len(scores)))
    assert [(r.unmatched, r.param_no) for r in pipeline.best_parameters(spark, sf).collect()] == [min(scores)]
    assert min(scores)[1] > 3


def test_clips_and_sets_solved_together_leave_what_each_leaves_alone():
    rng, words = random.Random(3), "а б в г д е".split()
    clips = [([[rng.choice(words) for _ in range(rng.randrange(5))] for _ in range(rng.randrange(9))], [rng.choice([*words, "", "х"]) for _ in range(rng.randrange(12))]) for _ in range(60)]
    grid = [{"skip": s, "least": t, "length_cost": c, "longest": n} for s in (0.5, 1.0) for t in (0.2, 0.4) for c in (0.0, 0.02) for n in (3, 15)] + [{}]
    for (segments, tokens), found in zip(clips, matching.unmatched(clips, grid)):
        for options, left in zip(grid, found):
            ends, _ = matching.span_boundaries(segments, tokens, **options)
            assert left == sum(a == b for a, b in zip(ends, ends[1:]))


def test_whole_keys_over_any_cuts_of_batches():
    rows = [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 2), ("c", 2), ("c", 2), ("d", 1)]
    table = pa.table({"k": [k for k, _ in rows], "n": [n for _, n in rows], "at": range(len(rows))})
    for size in range(1, 10):
        found = list(whole_keys(iter(table.to_batches(max_chunksize=size)), 2))
        assert [x for t in found for x in t.column("at").to_pylist()] == list(range(len(rows)))
        assert sum(len(begins(t, 2)) for t in found) == len(set(rows))
