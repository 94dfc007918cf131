from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from voxlattice.llm import lookalikes as L


@pytest.mark.parametrize(
    ("odd", "plain"),
    [("xpaнили", "хранили"), ("сοобща", "сообща"), ("лëд", "лёд"), ("свадьбой", "свадьбой"), ("ми​р­ом", "миром"), (" где ", "где"), ("ｓｈａｒｅｄ", "shared"), ("ѕріndles", "spindles"), ("по‑соседски", "по-соседски"), ("ﬁgs", "figs"), ("1９3１", "1931")],
)
def test_same_picture(odd, plain):
    assert L.canonical_token(odd) == L.canonical_token(plain) == plain


@pytest.mark.parametrize(("a", "b"), [("µ", "μ"), ("ﺍ", "ا"), ("Ⅷ", "VIII"), ("⼀", "一"), ("Ꭺ", "A"), ("ﬅ", "st"), ("‒", "–"), ("ǆ", "dž"), ("ﻼ", "لا"), ("ｱ", "ア"), ("ﬁне", "fiне"), ("e\u0308", "ё"), ("ꓮꓐ", "АВ")])
def test_more_of_one_picture(a, b):
    assert L.canonical_token(a) == L.canonical_token(b)


def test_stable_words_are_in_a_normal_form():
    assert L.stable("слово") and L.stable("word") and not L.stable("сло\u0301во") and not L.stable("cлово") and not L.stable("и\u0306ог")


@pytest.mark.parametrize(("a", "b"), [("l", "I"), ("0", "O"), ("3", "З"), ("№", "No"), ("ϐ", "β"), ("лед", "лёд"), ("Мир", "мир"), ("сн́ег", "снег"), ("ложки.", "ложки"), ("лжки", "ложки"), ("x²", "x2")])
def test_what_can_be_seen_stays(a, b):
    assert L.canonical_token(a) != L.canonical_token(b)


def test_texts_keep_their_script_and_are_stable():
    text = "Мы пoсле​ половодья искали ш‎ирок‌ие ухваты. A cop saw it."
    once = L.canonical_text(text)
    assert once == "Мы после половодья искали широкие ухваты. А сор saw it."
    assert L.canonical_text(once) == once
    assert L.canonical_text("A cop saw οne wооden οwl at a pond") == "A cop saw one wooden owl at a pond"
    assert L.canonical_text(None) is None and L.canonical_text("") == ""


def test_quick_check_lets_only_stable_words_pass():
    rng = random.Random(1)
    alphabet = "аосрхеувнкмтхabcehikmopxyтйё-.́​̆ｅο "
    for _ in range(20_000):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7)))
        form = L.canonical_token(word)
        assert L.canonical_token(form) == form, ascii(word)
        if L._STABLE.fullmatch(word):
            assert form == word.strip(), ascii(word)


def test_tokens_meet_the_lexicon(spark):
    tokens = spark.createDataFrame([(1, "миp"), (2, "мир"), (3, None), (4, ""), (5, "миp"), (6, "Миp"), (7, "м" * 50_000)], "token_id bigint, norm string").withColumn("form", F.lit("clash"))
    lexicon = spark.createDataFrame([(10, "мир"), (11, None), (12, "дом")], "lex_id bigint, norm string")
    assert sorted(map(tuple, L.lookalike_tokens(tokens, lexicon).collect())) == [(10, 1), (10, 5)]
    assert L.lookalike_tokens(tokens.limit(0), lexicon).collect() == []
    made = L.with_canonical(tokens, "norm", "form").orderBy("token_id").collect()
    assert [r.form for r in made][:4] == ["мир", "мир", None, ""]
