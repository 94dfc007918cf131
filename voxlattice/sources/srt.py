"""SRT files and texts: one reader whose flags give the ways they are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlattice.functions.timecode import code_ms


@dataclass(frozen=True)
class Rules:
    """How blocks are read.

    by_blank_lines: blocks end at lines of blanks too, not only at empty ones. needs_index: the first line must be
    a whole number. two_digits: times need two-digit fields anywhere in the line, else HH:MM:SS at its start.
    least_lines: lines a block must have. any_tag: any [..]: is a tag, kept with its colon, else only [SPEAKER_n]:,
    of which the name is kept. no_tag: what a block without tag gets. all_lines: text is all lines from the third
    on, joined by `join`; else the third only. dots: times with a dot. strict: what is skipped is an error.
    skip_lines: lines before the first whole number are passed over. any_times: whatever stands on both sides of the
    arrow is a time.
    """

    by_blank_lines: bool = True
    needs_index: bool = True
    least_lines: int = 2
    any_tag: bool = False
    no_tag: str | None = None
    all_lines: bool = True
    join: str = " "
    dots: bool = False
    needs_text: bool = False
    strict: bool = False
    skip_lines: bool = False
    any_times: bool = False


#: The readers of the merging, spanning, embedding and cutting stages.
MERGE = Rules(skip_lines=True, any_times=True)
SPAN = Rules(any_tag=True, no_tag="", join="\n")
EMBED = Rules(by_blank_lines=False, needs_index=False, least_lines=3, no_tag="UNKNOWN", all_lines=False)
CUT = Rules(least_lines=3, any_tag=True, no_tag="UNKNOWN", all_lines=False, dots=True, strict=True)

_TIMES = r"([0-9]{2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3})\s*-->\s*([0-9]{2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3})"


def parse_blocks(df: DataFrame, text: str, rules: Rules = MERGE) -> DataFrame:
    """df without `text` but with a row for each block: block_no, srt_index, start_code, end_code, start_ms, end_ms, speaker_tag, text, orig_lines and bad.

    bad names what is wrong with a block (index, time, lines) and is NULL for a good one; with strict rules such
    rows stay, so that the caller may fail, else they are left out. NULL and empty texts have no blocks.
    """
    keys = [c for c in df.columns if c != text]
    s = F.regexp_replace(F.regexp_replace(F.col(text), r"\uFEFF", ""), r"\r\n?", "\n")
    s = F.regexp_replace(s, r"^\s*\n+|\s+$", "")
    blocks = df.where(F.trim(F.col(text)) != "").select(*keys, F.posexplode(F.split(s, r"\n\s*\n" if rules.by_blank_lines else r"\n\n+")).alias("block_no", "_block"))
    lines = blocks.withColumn("orig_lines", F.split("_block", "\n"))
    if rules.skip_lines:
        at = F.array_position(F.transform("orig_lines", lambda x: x.rlike(r"^\s*[0-9]+\s*\z")), True).cast("int")
        lines = lines.withColumn("orig_lines", F.when(at > 1, F.slice("orig_lines", at, F.size("orig_lines"))).otherwise(F.col("orig_lines")))
    line = lambda i: F.try_element_at(F.col("orig_lines"), F.lit(i))
    timed = line(2)
    times = r"^\s*(.*?)\s*-->\s*(.*?)\s*$" if rules.any_times else _TIMES
    found = lambda i: F.regexp_extract(timed, times, i)
    told = F.regexp_extract(timed, times, 0)
    code = lambda i: F.regexp_replace(found(i), ",", ".") if rules.dots else found(i)
    head = F.coalesce(line(3), F.lit(""))
    tagged = r"^\s*(\[[^\]]+\]:)\s*" if rules.any_tag else r"^\s*\[(SPEAKER_[0-9]+)\]:\s*"
    tag = F.regexp_extract(head, tagged, 1)
    if rules.any_tag and rules.no_tag == "UNKNOWN":
        tag = F.regexp_replace(tag, r"^\[|\]:$", "")
    rest = F.slice("orig_lines", 4, F.greatest(F.size("orig_lines") - 3, F.lit(0))) if rules.all_lines else F.array().cast("array<string>")
    body = F.trim(F.concat_ws(rules.join, F.concat(F.array(F.regexp_replace(head, tagged, "")), rest)))
    bad: Column = F.when(F.size("orig_lines") < rules.least_lines, "lines").when(told == "", "time").when(timed.isNull(), "time")
    if rules.needs_index:
        bad = F.coalesce(F.when(~line(1).rlike(r"^\s*[0-9]+\s*$"), "index"), bad)
    out = lines.select(
        *keys, "block_no", F.trim(line(1)).try_cast("int").alias("srt_index"), code(1).alias("start_code"), code(2).alias("end_code"), code_ms(found(1)).alias("start_ms"), code_ms(found(2)).alias("end_ms"),
        F.when(tag != "", tag).otherwise(F.lit(rules.no_tag)).alias("speaker_tag"), body.alias("text"), "orig_lines", bad.alias("bad"),
    )
    return out if rules.strict else out.where("bad IS NULL")


def scan_srt(spark: SparkSession, path: str, rules: Rules = MERGE) -> DataFrame:
    """S-13, S-14: all SRT files below a folder, with recording_id and seg_no from names like rec_1No7.srt."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.srt")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.srt$", 1)
    named = raw.select(F.regexp_extract(name, r"^(.*)No([0-9]+)$", 1).alias("recording_id"), F.regexp_extract(name, r"^(.*)No([0-9]+)$", 2).try_cast("int").alias("seg_no"), F.col("value").alias("srt"))
    return parse_blocks(named, "srt", rules)


def block_text(index: Column, start: Column, end: Column, tag: Column, text: Column) -> Column:
    """K-07, K-08: one block as it stands in a file, without the blank line after it. A NULL or empty tag is left out."""
    said = F.concat(F.when(F.coalesce(tag, F.lit("")) != "", F.concat(tag, F.lit(" "))).otherwise(""), F.coalesce(text, F.lit("")))
    return F.concat_ws("\n", index.cast("string"), F.concat(start, F.lit(" --> "), end), said)


def render_srt(df: DataFrame, keys: list[str], order: str, tag: str = "speaker_tag") -> DataFrame:
    """keys and srt, the text of each file with its blocks in order. A file is a clip's blocks, as it is written."""
    block = block_text(F.col("srt_index"), F.col("start_code"), F.col("end_code"), F.col(tag), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), block.alias("b"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "\n\n").alias("srt"))
