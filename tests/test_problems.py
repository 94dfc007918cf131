"""Problems 1, 2 and 4: small cases, brute force, and odd tables."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voxlattice.operators import bad_rows, hierarchy, intervals
from voxlattice.operators.latest import latest
from voxlattice.operators.ordered import blocked_scan


def brute_periods(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_gaps_and_periods_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(k, a := rng.randrange(200), a + rng.randrange(0, 12)) for k in ("x", "y", "z") for _ in range(25)]
    rows += [rows[0], rows[0], (None, 1, 2), ("x", None, 5), ("x", 9, 4), ("n", 5, 5)]
    df = spark.createDataFrame(rows, "who string, start_ms bigint, end_ms bigint").withColumn("gap_start", F.lit("clash"))
    periods = {(r.who, r.period_start, r.period_end) for r in intervals.periods(df, ["who"], block_length=block).collect()}
    gaps = {(r.who, r.gap_start, r.gap_end) for r in intervals.gaps(df, ["who"], block_length=block).collect()}
    want_p, want_g = set(), set()
    for k in "xyz":
        got = brute_periods([(a, b) for w, a, b in rows if w == k and a is not None and b is not None and b > a])
        want_p |= {(k, *p) for p in got}
        want_g |= {(k, p[1], q[0]) for p, q in zip(got, got[1:])}
    assert periods == want_p
    assert gaps == want_g


def test_intervals_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "who string, start_ms bigint, end_ms bigint")
    assert intervals.gaps(empty, ["who"]).collect() == []
    assert intervals.periods(empty, ["who"]).collect() == []


def test_timed_blocks_take_the_latest_version(spark):
    t = lambda n: datetime(2024, 1, n)
    rows = [
        ("r", 0, 1, "00:00:01,000", "00:00:02,000", "[SPEAKER_01]:", t(1)),
        ("r", 0, 1, "00:00:05,000", "0:00:06 , 500", "Спикер 1:", t(2)),
        ("r", 0, 2, "нет", "00:00:02,000", "[SPEAKER_01]:", t(1)),
        ("r", 0, 3, "00:00:01,000", "00:00:61,000", "[SPEAKER_01]:", t(1)),
        ("r", 0, 4, "00:00:01,000", "00:00:02,000", None, t(1)),
        ("r", 0, 5, "00:00:03,000", "00:00:02,000", "SPK1", None),
    ]
    df = spark.createDataFrame(rows, "recording_id string, seg_file_no int, srt_index int, start_code string, end_code string, speaker_tag string, loaded_at timestamp")
    assert [tuple(r) for r in intervals.timed_blocks(df).collect()] == [("r", 0, 1, 5000, 6500, 1)]
    assert latest(df.limit(0), ["recording_id"], ["srt_index"]).collect() == []


@pytest.mark.parametrize("block", [3, 1000])
def test_blocked_scan_against_plain_windows(spark, block):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), i, rng.choice([None, 1, 2, 3])) for i in range(60)] + [(None, 1, 1), ("a", None, 4)]
    df = spark.createDataFrame(rows, "k string, o int, v int").withColumn("b", F.floor(F.col("o") / block))
    got = blocked_scan(df, ["k"], "b", "o", sums={"s": "v"}, before={"p": "v"}, after={"n": "v"}).collect()
    kept = sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1]))
    assert len(got) == len(kept)
    for r in got:
        own = [x for x in kept if x[0] == r.k]
        assert r.s == sum(x[2] or 0 for x in own if x[1] <= r.o)
        assert r.p == next((x[2] for x in reversed(own) if x[1] < r.o and x[2] is not None), None)
        assert r.n == next((x[2] for x in own if x[1] > r.o and x[2] is not None), None)


@pytest.mark.parametrize("wide", [2, 256])
def test_hierarchy_against_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(hierarchy, "WIDE", wide)
    rng = random.Random(3)
    parents = {(g, v): rng.choice([None, rng.randrange(40), v, 99, -1]) if rng.random() < 0.9 else v - 1 for g in ("a", "b") for v in range(40)}
    parents |= {("deep", v): v - 1 if v else None for v in range(70)}
    rows = [(g, v, p) for (g, v), p in parents.items()] + [(None, 1, None), ("a", None, 1)]
    tree = hierarchy.hierarchy(spark.createDataFrame(rows, "g string, v int, p int").withColumn("root", F.lit("clash")), "g", "v", "p", paths=True)
    got = {(r.g, r.v): r for r in tree.collect()}
    assert set(got) == set(parents)

    def up(g, v):
        path = [v]
        while (p := parents[g, path[-1]]) is not None and (g, p) in parents:
            if p in path:
                return None
            path.append(p)
        return path[::-1]

    below = {}
    for g, v in parents:
        path = up(g, v)
        r = got[g, v]
        assert r.on_cycle == (path is None)
        if path is not None:
            assert (r.root, r.depth, r.path) == (path[0], len(path) - 1, path)
            for a in path:
                below.setdefault((g, a), set()).add(v)
    for (g, v), members in below.items():
        r = got[g, v]
        assert r.size == len(members)
        assert {x for (h, x), y in got.items() if h == g and y.pre and r.pre <= y.pre < r.pre + r.size} == members
    pairs = {(r.g, r.v, r.descendant) for r in hierarchy.descendants(tree, "g", "v").collect()}
    assert pairs == {(g, v, x) for (g, v), m in below.items() for x in m if x != v}


def test_hierarchy_of_an_empty_table(spark):
    assert hierarchy.hierarchy(spark.createDataFrame([], "g string, v int, p int"), "g", "v", "p").collect() == []


GOOD = "1,00:00:01.000,00:00:02.000,S,text"


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        (GOOD, None), (GOOD + "\r", None), (' 007 ,00:00:01.000,00:00:02,000,S,"a ""b"", c"'.replace("02,000", "02.000"), None), ('"1","00:00:01,000","00:00:02,000","","a\nb"', None),
        (GOOD + '"', "quoting"), ('1,00:00:01.000,00:00:02.000,S,"text', "quoting"), ('1,00:00:01.000,00:00:02.000,S,"a" b', "quoting"), (' "1",00:00:01.000,00:00:02.000,S,t', "quoting"),
        ("", "columns"), (None, "columns"), (GOOD + ",", "columns"), ("1,2", "columns"),
        ("x,00:00:01.000,00:00:02.000,S,t", "index"), ("2147483648,00:00:01.000,00:00:02.000,S,t", "index"), ("１,00:00:01.000,00:00:02.000,S,t", "index"), ("2147483647,00:00:01.000,00:00:02.000,S,t", None),
        ("1,0:00:01.000,00:00:02.000,S,t", "start"), ("1,00:60:01.000,?,S,t", "start"), ("1,00:00:01.000,?,S,t", "end"), ("1,00:00:02.000,00:00:02.000,S,", "order"),
        ("1,00:00:01.000,00:00:02.000,S,​ ", "text"), ("1,00:00:01.000,00:00:02.000,S,—", None),
    ],
)
def test_reasons(line, reason):
    assert bad_rows.parse_line(line, ",")[0] == reason


def test_least_edits_make_the_line_parse():
    rng = random.Random(5)
    for _ in range(4000):
        line = "".join(rng.choice('ab",,') for _ in range(rng.randrange(14)))
        cost, edits = bad_rows.least_edits(line, ",")
        assert (cost == 0) == (bad_rows.zero_cost(line, ",") is not None)
        assert cost == sum(bad_rows.QUOTE if e[-1] == '"' else bad_rows.DELIMITER for e, _ in edits)
        chars = list(line)
        for edit, at in reversed(edits):
            if edit[0] == "d":
                # A delimiter beyond the last field goes with what is in the field it would begin.
                assert chars.pop(at) == edit[-1]
            else:
                chars.insert(at, edit[-1])
        if not any(e == "delete," for e, _ in edits):
            assert bad_rows.zero_cost("".join(chars), ",") is not None, (line, edits)


def brute_edits(line: str, most: int) -> tuple[int, int] | None:
    """Fewest edits of quotes, then of delimiters, by trying all of up to `most`; delimiters beyond the last are just counted."""
    level, seen = {line}, {line}
    for quotes in range(most + 1):
        counts = [abs(len(f) - bad_rows.FIELDS) for x in level if (f := sound_fields(x)) is not None]
        if counts:
            return quotes, min(counts)
        level = {y for x in level for at in range(len(x) + 1) for y in ([x[:at] + '"' + x[at:]] + ([x[:at] + x[at + 1 :]] if x[at : at + 1] == '"' else []))} - seen
        seen |= level
    return None


def sound_fields(line: str) -> list[str] | None:
    import re

    field = r'(?:"(?:[^"]|"")*"|[^",]*)'
    return re.findall(rf"(?:^|,)({field})", line) if re.fullmatch(f"{field}(?:,{field})*", line) else None


def test_least_edits_against_all_edits():
    rng = random.Random(6)
    for _ in range(400):
        line = "".join(rng.choice('a",,') for _ in range(rng.randrange(9)))
        want = brute_edits(line, 2)
        if want is not None:
            cost, _ = bad_rows.least_edits(line, ",")
            assert cost == want[0] * bad_rows.QUOTE + want[1], line


def test_the_edits_tell_the_reason(monkeypatch):
    lines = ['1,00:00:01.000,00:00:02.000,S,"text', "1,2", GOOD + ",", GOOD]
    assert [bad_rows.parse_line(x, ",")[0] for x in lines] == ["quoting", "columns", "columns", None]
    assert bad_rows.parse_line(lines[2], ",")[1:4] == ("delete, 34", 0, 1)
    monkeypatch.setattr(bad_rows, "least_edits", lambda line, d: (0, []))
    assert [bad_rows.parse_line(x, ",")[0] for x in lines] == ["columns", "columns", "columns", None]


def test_parse_rows_of_odd_tables(spark):
    long_line = "1,00:00:01.000,00:00:02.000,S," + '"' + 'a""' * 50_000 + '"'
    rows = [(1, "f", "CSV", GOOD), (2, None, None, None), (3, "f", "tsv", GOOD.replace(",", "\t")), (4, "f", "csv", long_line), (4, "f", "csv", long_line)]
    df = spark.createDataFrame(rows, "line_id bigint, file_name string, file_format string, raw_line string").withColumn("reason", F.lit("clash"))
    good, bad = bad_rows.split_rows(df)
    assert sorted(r.line_id for r in good.collect()) == [1, 3, 4, 4]
    assert [tuple(r)[:2] for r in bad.collect()] == [(2, "columns")]
    assert bad_rows.parse_rows(df.limit(0)).collect() == []
