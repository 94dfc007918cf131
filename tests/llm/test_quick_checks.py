"""Quick checks must let pass only what the whole check would."""

from __future__ import annotations

from voxlattice.llm import lookalikes as L
from voxlattice.llm import turns


def test_a_token_that_ends_in_a_line_break_meets_the_lexicon(spark):
    tokens = spark.createDataFrame([(1, "мир\n"), (2, "мир\r\n"), (3, "йод\n"), (4, "йод")], "token_id bigint, norm string")
    lexicon = spark.createDataFrame([(10, "мир"), (11, "йод")], "lex_id bigint, norm string")
    assert sorted(map(tuple, L.lookalike_tokens(tokens, lexicon).collect())) == [(10, 1), (10, 2), (11, 3)]


def test_drawn_out_fillers_with_hyphens_are_no_speech():
    noise = turns.Noise(["ну", "вот", "ага"], [])
    got = [(noise.surely_speech(x), noise.silent(x)) for x in ("ну-ууу", "во-ооот", "ага‑ааа", "ну, ага-ааа.", "дом", "во-ооот дом")]
    assert got == [(False, True)] * 4 + [(True, False)] * 2
