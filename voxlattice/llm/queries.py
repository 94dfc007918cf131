"""Queries of the training-text operators, and SQL where it can express them."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlattice.llm import leaks, lookalikes, mixture, sentences, spam, turns
from voxlattice.runtime import read_table

Query = Callable[[SparkSession, str], DataFrame]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Ends of the sentence units of hand-made and recognised texts."""
    made = read_table(spark, sf, "transcripts").select(F.lit("transcript").alias("origin"), F.col("transcript_id").alias("row_id"), F.col("transcript").alias("text"))
    heard = read_table(spark, sf, "whisper_segments").select(F.lit("whisper").alias("origin"), F.col("whisper_id").alias("row_id"), "text")
    return sentences.sentence_ends(made.unionByName(heard), ["origin", "row_id"]).distinct()


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Speaker turns of recognised and hand-made transcripts."""
    fillers, sounds = turns.noise_terms(read_table(spark, sf, "noise_terms"))
    recognised = turns.srt_lines(read_table(spark, sf, "srt_segments"), fillers, sounds)
    made = turns.manual_lines(read_table(spark, sf, "manual_segments"), read_table(spark, sf, "audio_catalog"), fillers, sounds)
    return turns.turns(recognised.unionByName(made))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens that look like a lexicon entry but differ in characters."""
    return lookalikes.lookalike_tokens(read_table(spark, sf, "t2_tokens"), read_table(spark, sf, "norm_lexicon"))


def p6_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Every transcript in its one form, with a flag for those that changed."""
    texts = read_table(spark, sf, "transcripts").select("transcript_id", "transcript")
    made = lookalikes.with_canonical(texts, "transcript", "canonical")
    return made.select("transcript_id", "canonical", (F.col("canonical") != F.col("transcript")).alias("changed"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold at least half of an evaluation item."""
    return leaks.leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "eval_items"))


#: A curriculum: crawled pages fade out, letters and diaries come in.
SCHEDULES = {"web_crawl": [(0.0, 1.5), (1.0, 0.5)], "museum_letters": [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)], "school_diaries": [(0.0, 0.0), (0.4, 1.0), (1.0, 1.0)]}


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the mixture in the order of training."""
    sized = mixture.sized_documents(read_table(spark, sf, "documents"))
    return mixture.mixture(sized, read_table(spark, sf, "mixture_targets"), schedules=SCHEDULES)[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares of the mixture's sources."""
    sized = mixture.sized_documents(read_table(spark, sf, "documents"))
    return mixture.shares(*mixture.mixture(sized, read_table(spark, sf, "mixture_targets"), schedules=SCHEDULES))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of which more than half is keywords, tags, goods or links."""
    return spam.spam_documents(read_table(spark, sf, "documents")).select("doc_id")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p3_found, p5_found, p6_found, p6_transcripts, p7_found, p8_mixture, p8_shares, p9_found)}


def _looks_sql(column: str) -> str:
    """DuckDB expression for what a token looks like: letters of one shape as one of them, composed, without what can't be
    seen. The table of pairs is made of the characters of all blocks of alphabetic scripts and of compatibility forms
    that come out as one character; the few that come out as more follow."""
    rep = {c: next(x for x in r if x != "-") for r in lookalikes._ROWS for c in r if c != "-"}
    pairs, longer = {}, {}
    for a, z in ((0x21, 0x24F), (0x250, 0x2FF), (0x370, 0x58F), (0x13A0, 0x13FF), (0x1D00, 0x1D7F), (0x1E00, 0x1FFF), (0x2010, 0x2015), (0x2160, 0x217F), (0x2E80, 0x2FD5), (0xA4D0, 0xA4FF), (0xFB00, 0xFB17), (0xFE70, 0xFEFC), (0xFF01, 0xFFEE)):
        for c in map(chr, range(a, z + 1)):
            made = unicodedata.normalize("NFC", "".join(rep.get(x, x) for x in lookalikes._shape(c)))
            if made != c and made:
                (pairs if len(made) == 1 else longer)[c] = made
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = f"{quoted(''.join(pairs))}, {quoted(''.join(pairs.values()))}"
    ignorable = "".join(c if c == "-" else f"\\x{{{ord(c):X}}}" for c in lookalikes._IGNORABLE.pattern.strip("[]"))
    out = f"regexp_replace({column}, '[{ignorable}]', '', 'g')"
    for c, made in longer.items():
        out = f"replace({out}, {quoted(c)}, {quoted(made)})"
    # Letters are brought to one shape before marks are composed with them, and composed ones after.
    out = f"translate(nfc_normalize(translate({out}, {table})), {table})"
    return rf"regexp_replace({out}, '^[\s\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}]+|[\s\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}]+$', '', 'g')"


ORACLE: dict[str, str] = {
    "p6_found": f"""WITH t AS (SELECT token_id, norm, {_looks_sql('norm')} AS form FROM t2_tokens), x AS (SELECT lex_id, norm, {_looks_sql('norm')} AS form FROM norm_lexicon)
SELECT DISTINCT x.lex_id, t.token_id FROM t JOIN x USING (form) WHERE t.norm <> x.norm AND form <> ''"""
}
