from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlattice.llm import leaks as L

WORDS = ["рыбаки", "чинили", "сети", "у", "брода", "бабы", "носили", "корзины", "в", "амбар", "кузнецы", "точили", "косы", "на", "гумне", "зимой", "весной", "старые", "новые", "лодки"]


def passage(rng, n):
    return [rng.choice(WORDS) + rng.choice("абвгдежз") for _ in range(n)]


def test_winnowing_keeps_a_common_gram_of_every_long_shared_span():
    rng = random.Random(0)
    for _ in range(300):
        shared = [rng.randrange(1, 9) for _ in range(L.K + L.W - 1)]
        texts = [[rng.randrange(1, 9) for _ in range(rng.randrange(6))] + shared + [rng.randrange(1, 9) for _ in range(rng.randrange(6))] for _ in "ab"]
        kept = [set(L.winnow(np.array(t), np.zeros(len(t), np.int64))[0].tolist()) for t in texts]
        assert kept[0] & kept[1]


def test_texts_of_a_batch_do_not_touch():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([6, 7])
    both = L.winnow(np.concatenate([a, b]), np.array([0] * 5 + [1] * 2))
    alone = [L.winnow(x, np.zeros(len(x), np.int64))[0].tolist() for x in (a, b)]
    assert both[0].tolist() == alone[0] + alone[1]


def test_planted_leaks_are_found_and_decoys_are_not(spark):
    rng = random.Random(1)
    items = [passage(rng, 40) for _ in range(30)]
    docs, want = [], set()
    for i, item in enumerate(items):
        around = lambda: passage(rng, 60)
        edited = [w for k, w in enumerate(item) if k % 9] if i % 3 else [x for k, w in enumerate(item) for x in ([w, "вдруг"] if k % 10 == 5 else [w])]
        kept = edited[: len(edited) * 3 // 4] if i % 2 else edited
        if i % 5 == 0:
            kept = kept[:15] + ["это", "было", "давно", "и", "не", "здесь"] + kept[15:]
        docs.append((i, " ".join(around()) + ". " + ", ".join(kept).upper().replace("О", "O") + "! " + " ".join(around())))
        want.add((i, i))
        shuffled = item[:]
        rng.shuffle(shuffled)
        docs += [(100 + i, " ".join(passage(rng, 50) + item[:15] + passage(rng, 50))), (200 + i, " ".join(shuffled))]
    docs += [(900, None), (901, ""), (902, "..."), (0, docs[0][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    it = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(99, None), (98, "")], "item_id bigint, text string")
    assert {tuple(r) for r in L.leaks(d, it).collect()} == want
    assert {tuple(r) for r in L.leaks(d, it, block_bytes=4000).collect()} == want
    assert L.leaks(d.limit(0), it).collect() == [] and L.leaks(d, it.limit(0)).collect() == []


def test_a_long_text_is_searched_to_its_end(spark):
    rng = random.Random(2)
    item = passage(rng, 30)
    d = spark.createDataFrame([(1, " ".join(["слово"] * 200_000 + item))], "doc_id bigint, text string")
    assert L.leaks(d, spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")).collect()[0][:] == (5, 1)


@pytest.mark.parametrize("aside", [10, 59, 61, 200, 5000])
def test_an_aside_of_any_length_parts_a_passage(spark, aside):
    rng = random.Random(3)
    item = passage(rng, 40)
    there = passage(rng, 30) + item[:15] + passage(rng, aside) + item[20:35] + passage(rng, 30)
    back = passage(rng, 30) + item[20:35] + passage(rng, aside) + item[:15] + passage(rng, 30)
    short = passage(rng, 30) + item[:6] + passage(rng, aside) + item[10:16] + passage(rng, aside) + item[20:26] + passage(rng, 30)
    d = spark.createDataFrame([(1, " ".join(there)), (2, " ".join(back)), (3, " ".join(short[: len(short) if aside > L.NEAR else 42]))], "doc_id bigint, text string")
    it = spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")
    assert {tuple(r) for r in L.leaks(d, it).collect()} == {(5, 1)}


def test_short_items(spark):
    d = spark.createDataFrame([(1, "Старые лодки"), (2, "у брода старые лодки стоят"), (3, "старые"), (4, "чинили старые лодки у брода")], "doc_id bigint, text string")
    it = spark.createDataFrame([(5, "старые лодки!"), (6, "чинили старые лодки"), (7, "старые лодки у брода")], "item_id bigint, text string")
    assert {tuple(r) for r in L.leaks(d, it).collect()} == {(5, 1), (6, 4), (7, 4)}


def test_the_bloom_filter_has_all_that_was_added_and_a_bound(monkeypatch):
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 5000).astype(np.uint64)
    bloom = L.Bloom(len(h))
    bloom.add(h)
    other = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert bloom.may_have(h).all() and bloom.may_have(other).mean() < 0.02
    monkeypatch.setattr(L, "MOST_BLOOM_BITS", 1 << 12)
    small = L.Bloom(10**9)
    small.add(h)
    assert small.set.nbytes == 512 and small.may_have(h).all()


def test_words_are_one_however_they_are_written():
    assert L.words("Ко\\рова, ко́рова КО_РОВА ｋорова корo\u00adва") == ["корова"] * 3 + [L.words("ｋорова")[0]] + ["корова"]
    assert L.words("йод е\u0308лка \u0438\u0306од ёлка") == ["йод", "ёлка", "йод", "ёлка"]
    assert L.words("去年秋天 a1-b2 \u0301 _") == ["去", "年", "秋", "天", *L.words("a1"), *L.words("b2")]
    number = L.Numbers()
    assert number.of("Корова \u0301 ко́рова").tolist() == [number["корова"]] * 2
