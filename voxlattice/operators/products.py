"""What the matching stages make: subtitles with the text of the transcript, and pairs of dialect segments."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from voxlattice.functions import text as T
from voxlattice.functions.similarity import cosine, length_ratio_ok
from voxlattice.operators.matching import span_boundaries
from voxlattice.operators.segments import banded_pairs, best_matches, filled_speakers, missing
from voxlattice.sources.srt import block_text

Encoder = Callable[[list[str]], np.ndarray]


def merged_spans(blocks: DataFrame, transcripts: DataFrame, keys: list[str], **options: float) -> DataFrame:
    """J-10 put to use: keys, srt_index, start_code, end_code, speaker_tag, text, matched.

    blocks: keys and the columns of a parsed file; transcripts: keys, transcript, one for each clip. A block that took
    tokens gets what stands in the transcript from the first to the last of them, as it stands; the others keep their
    text. The tag stays. Clips without transcript keep all texts; transcripts without blocks give nothing.
    """
    kinds = ", ".join(f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys)

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a = a.sort_values("srt_index")
        whole = b["transcript"].iloc[0] if len(b) and b["transcript"].iloc[0] else ""
        found = T.tokens(whole)
        ends, _ = span_boundaries([T.token_norm(x or "").split() for x in a["text"].tolist()], [n for _, n, _, _ in found], **options)
        said = [whole[found[x][2] : found[y - 1][3]] if y > x else t for t, x, y in zip(a["text"].tolist(), ends, ends[1:])]
        kept = zip(*(a[c].tolist() for c in ("srt_index", "start_code", "end_code", "speaker_tag")), said, (y > x for x, y in zip(ends, ends[1:])))
        return pd.DataFrame([(*key, *row) for row in kept], columns=[*keys, "srt_index", "start_code", "end_code", "speaker_tag", "text", "matched"])

    taken = blocks.select(*keys, "srt_index", "start_code", "end_code", "speaker_tag", "text").where("srt_index IS NOT NULL")
    return taken.groupBy(*keys).cogroup(transcripts.select(*keys, "transcript").groupBy(*keys)).applyInPandas(run, f"{kinds}, srt_index int, start_code string, end_code string, speaker_tag string, text string, matched boolean")


def merged_srt(merged: DataFrame, keys: list[str]) -> DataFrame:
    """K-08: keys, srt: the merged blocks in order, each with a line break at its end, joined by line breaks; a tag is followed by one blank."""
    block = F.concat(block_text(F.col("srt_index"), F.col("start_code"), F.col("end_code"), F.rtrim("speaker_tag"), F.col("text")), F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("srt_index").alias("o"), block.alias("b"))))
    return merged.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "\n").alias("srt"))


def _said(line: Column, labelled: Column) -> Column:
    """A transcript line without the label at its head, if that is the one taken, and without brackets around all of it."""
    after = F.regexp_replace(line, r"(?s)^\[[A-Za-zА-Яа-яЁё.?]{1,8}\s*:", "")
    inner, tail = T.strip(F.regexp_replace(after, r"(?s)\].*$", "")), T.strip(F.regexp_replace(after, r"(?s)^[^\]]*\]", ""))
    rest = F.when(after.contains("]"), T.strip(F.concat_ws(" ", F.when(inner != "", inner), F.when(tail != "", tail)))).otherwise(T.strip(after))
    whole = F.when(labelled, rest).otherwise(T.strip(line))
    return F.when(whole.rlike(r"(?s)^\[.+\]$"), T.strip(F.substring(whole, 2, F.length(whole) - 2))).otherwise(whole)


def composed(blocks: DataFrame, lines: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """T-12, W-05: keys, srt_index, speaker, new_text of every block.

    blocks: keys, srt_index, speaker (SPEAKER_n or NULL), orig_lines; lines: keys, pos, orig; matches: keys, srt_index, pos.
    A matched block gets its lines in order, joined by blanks; the first label among them names the speaker, else the
    label in force from matched blocks before, else the block's own. Unmatched blocks keep their lines as they were.
    """
    own = matches.join(lines, [*keys, "pos"]).withColumn("label", F.regexp_extract("orig", r"^\[([A-Za-zА-Яа-яЁё.?]{1,8})\s*:", 1))
    within = Window.partitionBy(*keys, "srt_index").orderBy("pos")
    taken = own.withColumn("first", F.first(F.when(F.col("label") != "", F.col("pos")), True).over(within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    said = taken.withColumn("said", _said(F.col("orig"), F.col("first").eqNullSafe(F.col("pos"))))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "said")))
    text = F.array_join(F.filter(F.transform(ordered, lambda x: x["said"]), lambda x: x != ""), " ")
    joined = said.groupBy(*keys, "srt_index").agg(text.alias("content"), F.min_by("label", F.when(F.col("first") == F.col("pos"), F.col("pos"))).alias("label"))
    named = joined.join(blocks.select(*keys, "srt_index", "speaker"), [*keys, "srt_index"]).select(
        *keys, "srt_index", "content", F.when(F.col("label") != "", F.concat(F.lit("["), "label", F.lit(":]"))).alias("explicit"), F.when(F.col("speaker") != "", F.concat(F.lit("["), "speaker", F.lit("]"))).alias("placeholder")
    )
    filled = filled_speakers(named, keys, "srt_index", "explicit", "placeholder", "bracket").select(*keys, "srt_index", "content", "bracket")
    prefix = F.when(F.col("bracket").contains(":"), F.col("bracket")).otherwise(F.concat("bracket", F.lit(":")))
    new = F.when(F.col("bracket").isNull(), F.col("content")).otherwise(T.strip(F.concat_ws(" ", prefix, F.when(F.col("content") != "", F.col("content")))))
    made = filled.select(*keys, "srt_index", F.col("bracket").alias("speaker"), T.strip(new).alias("new_text"), F.lit(True).alias("matched"))
    whole = blocks.select(*keys, "srt_index", F.array_join("orig_lines", "\n").alias("was")).join(made, [*keys, "srt_index"], "left")
    return whole.select(*keys, "srt_index", "speaker", F.when(F.col("matched"), F.col("new_text")).otherwise(F.coalesce("was", F.lit(""))).alias("new_text"))


def final_runs(sources: DataFrame, targets: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """T-15: keys, l_pos, pieces of each recognised sentence that was reached.

    sources: keys, l_pos, orig; targets: keys, r_pos, orig; matches: keys, l_pos, r_pos. A matched one is the header of its
    block, if it has one, and the transcript's sentences; an unmatched one is kept whole. Where a clip has no
    transcript only its first sentence is reached.
    """
    header = F.regexp_extract("orig", r"^[0-9]+\n[0-9]+:[0-9]+:[0-9]+,[0-9]+ --> [0-9]+:[0-9]+:[0-9]+,[0-9]+\n\[SPEAKER_[0-9]+\]:", 0)
    met = matches.join(targets.select(*keys, "r_pos", F.col("orig").alias("said")), [*keys, "r_pos"])
    own = met.groupBy(*keys, "l_pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("r_pos", "said"))), lambda x: x["said"]).alias("said"))
    some = targets.select(*keys).distinct().withColumn("has", F.lit(True))
    first = sources.groupBy(*keys).agg(F.min("l_pos").alias("first"))
    whole = sources.join(first, keys).join(some, keys, "left").where("has OR l_pos = first").join(own, [*keys, "l_pos"], "left")
    pieces = F.when(F.col("said").isNull(), F.array("orig")).when(header != "", F.concat(F.array(header), "said")).otherwise(F.col("said"))
    return whole.select(*keys, "l_pos", pieces.alias("pieces"))


def hashed_trigrams(texts: list[str], size: int = 256) -> np.ndarray:
    """An encoder that needs no model: counts of character trigrams, hashed, without case."""
    out = np.zeros((len(texts), size))
    for k, t in enumerate(texts):
        t = f" {t.lower()} "
        for i in range(len(t) - 2):
            out[k, zlib.crc32(t[i : i + 3].encode()) % size] += 1
    return out


def embedded(df: DataFrame, text: str, to: str = "vector", encoder: Callable[[], Encoder] = lambda: hashed_trigrams) -> DataFrame:
    """M-07: df with the vector of a text; encoder() is called once in each Python worker. NULL is encoded as ''."""
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        at = columns.index(text)
        for batch in batches:
            vectors = encode([t or "" for t in batch.column(at).to_pylist()]) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([list(map(float, v)) for v in vectors], pa.list_(pa.float64()))], [*columns, to])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(to, ArrayType(DoubleType()))]))


def dialect_texts(heard: DataFrame, made: DataFrame, keys: list[str], least: float = 0.65) -> tuple[DataFrame, DataFrame]:
    """Stage 6e, first part: (texts, counts). texts: keys, whisper_text, manual_text, the speech in dialect of both sides.

    heard: keys, pos, text of recognised segments; made: keys, pos, text of hand-made lines with collectors' speech in
    square brackets. What is in brackets is matched with recognised segments by edit distance (J-06), and both are
    dropped. counts (A-03): keys, totals and parts of both sides. Clips need both sides.
    """
    parts = made.select(*keys, "pos", F.posexplode(T.bracket_parts(F.col("text"))).alias("_part", "x")).select(*keys, "pos", "_part", F.col("x.text").alias("text"), F.col("x.is_dialect").alias("is_dialect"))
    place = F.struct("pos", "_part")
    standard = parts.where("NOT is_dialect").select(*keys, F.struct("pos", "_part").alias("l_at"), T.norm_edit(F.col("text")).alias("l_norm"))
    numbered = standard.withColumn("l_pos", F.row_number().over(Window.partitionBy(*keys).orderBy("l_at"))).drop("l_at")
    found = best_matches(numbered.where("l_norm <> ''"), heard.select(*keys, F.col("pos").alias("r_pos"), T.norm_edit(F.col("text")).alias("r_norm")).where("r_norm <> ''"), keys, least)
    marked = found.select(*keys, F.col("r_pos").alias("pos")).distinct()
    kept = missing(heard, marked, [*keys, "pos"])
    join = lambda at: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("text").alias("t")))), lambda x: x["t"]), " ")
    left = kept.where("text IS NOT NULL").groupBy(*keys).agg(join(F.col("pos")).alias("whisper_text"), F.count("*").alias("whisper_dialect"))
    right = parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("is_dialect"), F.struct(place.alias("at"), F.col("text").alias("t"))))), lambda x: x["t"]), " ").alias("manual_text"), F.count("*").alias("manual_total"), F.count_if("is_dialect").alias("manual_dialect"))
    total = heard.groupBy(*keys).agg(F.count("*").alias("whisper_total")).join(marked.groupBy(*keys).agg(F.count("*").alias("whisper_standard")), keys, "left")
    whole = total.join(right, keys).join(left, keys, "left").withColumn("whisper_standard", F.coalesce("whisper_standard", F.lit(0)))
    texts = whole.select(*keys, F.coalesce("whisper_text", F.lit("")).alias("whisper_text"), F.coalesce("manual_text", F.lit("")).alias("manual_text"))
    counts = whole.select(*keys, "whisper_total", (F.col("whisper_total") - F.col("whisper_standard")).alias("whisper_dialect"), "whisper_standard", "manual_total", "manual_dialect", (F.col("manual_total") - F.col("manual_dialect")).alias("manual_standard"))
    return texts, counts


def dialect_pairs(texts: DataFrame, keys: list[str], least: float = 0.5, window: int = 5, ratio: float = 2.0, encoder: Callable[[], Encoder] = lambda: hashed_trigrams) -> DataFrame:
    """Stage 6e, second part: keys, pair_no, source, target, sim, candidate, kept.

    Both texts are packed into segments (T-07, T-08) and encoded (M-07). Each source segment takes the most similar target
    within a band of `window` places (J-11; equal ones the earlier); of those, the longest chain in order stays. Pairs
    beyond `ratio` in words (F-11) or below `least` in cosine (M-06) have kept false. Originals are the first with the
    cleaned text (J-12). The library that aligns in the first place is approximated: this is a definition of our own.
    """
    segments = lambda c: T.joined_short(T.packed_sentences(F.col(c)))
    cut = lambda c: embedded(texts.select(*keys, F.posexplode(segments(c)).alias("pos", "x")).select(*keys, "pos", F.col("x.orig").alias("orig"), F.col("x.clean").alias("clean")), "clean", encoder=encoder)
    one = F.struct(*keys).alias("clip")
    a, b = cut("whisper_text").select(one, "pos", "orig", "clean", "vector"), cut("manual_text").select(one, "pos", "orig", "clean", "vector")
    near = banded_pairs(a.select("clip", "pos", "vector"), "clip", "pos", "vector", b.select("clip", "pos", "vector"), window)
    scored = near.select("clip", "i", "j", cosine(F.col("a"), F.col("b")).alias("sim"))
    best = scored.groupBy("clip", "i").agg(F.max(F.struct("sim", (-F.col("j")).alias("j"))).alias("x")).select("clip", "i", (-F.col("x.j")).alias("j"), F.col("x.sim").alias("sim"))

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        return frame.iloc[longest_rise(frame["j"].tolist())]

    # One row for each segment of a clip: the chain is sequential by nature.
    kept = best.select(F.col("clip").alias("clip"), "i", "j", "sim").groupBy("clip").applyInPandas(chain, best.schema)
    first = lambda df, pos, clean, orig: df.select("clip", F.col("pos").alias(pos), F.col("clean").alias(clean)).join(df.groupBy("clip", F.col("clean").alias(clean)).agg(F.min_by("orig", "pos").alias(orig)), ["clip", clean])
    back = kept.join(first(a, "i", "s_clean", "source"), ["clip", "i"]).join(first(b, "j", "t_clean", "target"), ["clip", "j"])
    size = lambda c: F.size(T.words(F.col(c)))
    ok = length_ratio_ok(size("s_clean"), size("t_clean"), ratio) & (F.col("sim") >= least)
    return back.select("clip.*", (F.col("i") + 1).alias("pair_no"), "source", "target", "sim", F.col("j").alias("target_no"), ok.alias("kept"))


def longest_rise(values: list[int]) -> list[int]:
    """Places of a longest rising subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for k, v in enumerate(values):
        x = bisect_left(tails, v)
        tails[x : x + 1] = [v]
        at[x : x + 1] = [k]
        before[k] = at[x - 1] if x else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def chain_summary(counts: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """K-11, A-03 to A-06: counts with initial and final pairs, mean similarity (0 of none), chain_score and success.

    chain_score is the share of neighbouring pairs whose targets are neighbours too, 0 of fewer than two pairs (a
    definition of our own).
    """
    w = Window.partitionBy(*keys).orderBy("pair_no")
    steps = pairs.withColumn("next", (F.lead("target_no").over(w) - F.col("target_no") == 1) & (F.lead("pair_no").over(w) - F.col("pair_no") == 1))
    per = steps.groupBy(*keys).agg(F.count("*").alias("initial_pairs"), F.count_if("kept").alias("final_pairs"), F.avg(F.when(F.col("kept"), F.col("sim"))).alias("mean"), F.count_if("next").alias("links"))
    score = F.when(F.col("initial_pairs") > 1, F.col("links") / (F.col("initial_pairs") - 1)).otherwise(0.0)
    return counts.join(per, keys, "left").select(*counts.columns, F.coalesce("initial_pairs", F.lit(0)).alias("initial_pairs"), F.coalesce("final_pairs", F.lit(0)).alias("final_pairs"), F.coalesce("mean", F.lit(0.0)).alias("mean_similarity"), F.coalesce(score, F.lit(0.0)).alias("chain_score"), (F.coalesce("final_pairs", F.lit(0)) > 0).alias("success"))


def with_errors(summary: DataFrame, clips: DataFrame, keys: list[str]) -> DataFrame:
    """K-11: the summary with a row for each clip that has none, whose `error` says what it lacks. clips: keys, has_srt, has_text."""
    error = F.when(~F.col("has_srt"), "no recognised blocks").when(~F.col("has_text"), "no transcript").otherwise("no result")
    lost = clips.join(summary.select(*keys), keys, "left_anti").select(*keys, F.lit(False).alias("success"), error.alias("error"))
    return summary.withColumn("error", F.lit(None).cast("string")).unionByName(lost, allowMissingColumns=True)


def outcome(summary: DataFrame) -> DataFrame:
    """A-06: how many clips succeeded and failed."""
    return summary.agg(F.count("*").alias("clips"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"))
