from __future__ import annotations

import pytest

from voxlattice.llm import mixture as M

TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 3), ("d", 0.1, 4)]


def sized(spark):
    rows = [(i, "A ", 10) for i in range(900)] + [(2000 + i, "b", 12) for i in range(200)] + [(4000 + i, "c", 7) for i in range(3)] + [(6000, None, 5), (6001, "z", 5), (6002, "a", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")


def test_shares_repeats_and_order(spark):
    targets = spark.createDataFrame(TARGETS, "source_name string, target_share double, max_repeats int")
    mixed, planned = M.mixture(sized(spark), targets, total=10_000, schedules={"a": [(0, 2), (1, 0)]})
    rows = mixed.collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    assert {k: sum(r.tokens for r in v) for k, v in by.items()} == {"a": 5000, "b": 3000, "c": 63}
    assert max(sum(1 for r in by["b"] if r.doc_id == i) for i in {r.doc_id for r in by["b"]}) <= 2
    assert all(0 <= r.position < 1 for r in rows) and [r.position for r in rows] == sorted(r.position for r in rows)
    # Weight 2(1 - t): half of the tokens come before 1 - sqrt(1/2), all in order.
    early = sum(r.tokens for r in by["a"] if r.position < 1 - 0.5**0.5)
    assert abs(early - 2500) <= 10
    shares = {r.source_name: r for r in M.shares(mixed, planned).collect()}
    assert shares["c"].reachable is False and shares["c"].most_uses == 3 and shares["d"].drawn_tokens == 0
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9


def test_nothing_to_mix(spark):
    targets = spark.createDataFrame(TARGETS, "source_name string, target_share double, max_repeats int")
    for s, t in ((sized(spark).limit(0), targets), (sized(spark), targets.limit(0))):
        mixed, planned = M.mixture(s, t)
        assert mixed.collect() == [] and all(r.drawn_tokens == 0 for r in M.shares(mixed, planned).collect())
    with pytest.raises(ValueError):
        M._pieces([(0, 0), (1, 0)])


def test_token_counts_round_trip(spark):
    texts = ["Да, в лесу.", "", None, "word " * 3000, "木匠 ok"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.tokens for r in M.with_tokens(df).collect()}
    encoder = M._encoder(M.TOKENIZER)
    assert all(encoder.decode(encoder.encode_ordinary(t)) == t for t in texts if t)
    assert got == {i: len(encoder.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}


def test_the_largest_mixture_within_reach(spark):
    """Source c has 63 tokens to give with all repeats, d none at all: the others stay at what they should be beside c."""
    targets = spark.createDataFrame(TARGETS, "source_name string, target_share double, max_repeats int")
    mixed, planned = M.mixture(sized(spark), targets, total=M.WITHIN_REACH)
    assert {p["source"]: round(p["given"]) for p in planned} == {"a": 315, "b": 189, "c": 63, "d": 0}
    shares = {r.source_name: r.actual_share for r in M.shares(mixed, planned).collect()}
    assert abs(shares["a"] - 5 / 9) < 0.02 and abs(shares["b"] - 3 / 9) < 0.02 and abs(shares["c"] - 1 / 9) < 0.01
