"""Queries of the corpus pipeline's own operators, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

import unicodedata
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlattice.functions import similarity as S
from voxlattice.functions import text as T
from voxlattice.functions.timecode import code_ms
from voxlattice.operators import batching, matching, products, reorder, segments
from voxlattice.operators.latest import latest
from voxlattice.plans.queries import latest_sql, ms_sql, query
from voxlattice.runtime import read_table, stage
from voxlattice.sources import manifest, sinks
from voxlattice.sources.index import transcript_records
from voxlattice.sources.srt import CUT, EMBED, MERGE, SPAN, Rules, block_text, parse_blocks, render_srt

CLIP = ["recording_id", "seg_file_no"]


def srt(spark: SparkSession, sf: str) -> DataFrame:
    """The latest version of each recognised block."""
    return latest(read_table(spark, sf, "srt_segments"), [*CLIP, "srt_index"], ["start_code", "end_code", "speaker_tag", "text"])


def index(spark: SparkSession, sf: str) -> DataFrame:
    return latest(read_table(spark, sf, "index_segments"), ["recording_id", "seg_no"], ["start_code", "trans", "cont", "prev", "text", "name"])


def manual(spark: SparkSession, sf: str) -> DataFrame:
    return latest(read_table(spark, sf, "manual_segments"), ["recording_id", "seg_no", "pos"], ["text", "is_dialect"])


SRT_SQL = latest_sql("srt_segments", "recording_id, seg_file_no, srt_index")
INDEX_SQL = latest_sql("index_segments", "recording_id, seg_no")
MANUAL_SQL = latest_sql("manual_segments", "recording_id, seg_no, pos")
_STRIP = r"regexp_replace({}, '^[\s\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{0085}}]+|[\s\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{0085}}]+$', '', 'g')"
_ONE = r"regexp_replace({}, '[\s\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{0085}}]+', ' ', 'g')"


def strip_sql(x: str) -> str:
    return _STRIP.format(x)


def squeeze_sql(x: str) -> str:
    return f"trim({_ONE.format(x)})"


def gsub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


@query(
    "catalog_names",
    """SELECT recording_id, original_name, lower(original_extension) AS ext,
  format('{}_{:03d}', regexp_extract(recording_id, '^([a-z]+)', 1), row_number() OVER (PARTITION BY regexp_extract(recording_id, '^([a-z]+)', 1) ORDER BY original_name, recording_id)) AS new_name
FROM audio_catalog WHERE lower(original_extension) IN ('.wav', '.wma', '.mp3')""",
)
def catalog_names(spark: SparkSession, sf: str) -> DataFrame:
    """S-01 to S-03, W-02: files of some suffixes in any case, renamed to a prefix and an ordinal."""
    prefix = F.regexp_extract("recording_id", "^([a-z]+)", 1)
    df = read_table(spark, sf, "audio_catalog").where(F.lower("original_extension").isin(".wav", ".wma", ".mp3"))
    place = F.row_number().over(Window.partitionBy(prefix).orderBy("original_name", "recording_id"))
    return df.select("recording_id", "original_name", F.lower("original_extension").alias("ext"), segments.ordinal_name(prefix, place).alias("new_name"))


_TRIMMED = strip_sql("text")
_ENDLESS = rf"regexp_replace({_TRIMMED}, '[^\p{{L}}\p{{N}}_]+$', '')"


@query(
    "index_lines",
    rf"""SELECT recording_id, seg_no, replace(regexp_extract({_TRIMMED}, '^[0-9:.,]{{12}}', 0), ',', '.') AS start,
  NOT contains(text, 'РАСПИСАНО') AS trans,
  CASE WHEN regexp_matches({_ENDLESS}, '[0-9:.,]{{12}}$') AND regexp_matches(lower({_TRIMMED}), 'продолж') THEN replace(regexp_extract({_ENDLESS}, '[0-9:.,]{{12}}$', 0), ',', '.') END AS cont
FROM {INDEX_SQL} WHERE regexp_matches({_TRIMMED}, '^[0-9:.,]{{12}}[ -\x{{2013}}]')""",
)
def index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """S-04, T-01 to T-03, F-01 to F-03: codes, flags and continuations of index lines."""
    line = F.col("text")
    return index(spark, sf).where(T.starts_with_code(line)).select("recording_id", "seg_no", T.time_code(line).alias("start"), T.is_transcribed(line).alias("trans"), T.continuation_code(line).alias("cont"))


@query(
    "segment_numbers",
    f"""SELECT recording_id, seg_no, row_number() OVER (PARTITION BY recording_id ORDER BY seg_no) - 1 AS place,
  recording_id || 'No' || (row_number() OVER (PARTITION BY recording_id ORDER BY seg_no) - 1) || '.wav' AS clip FROM {INDEX_SQL}""",
)
def segment_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """W-01, W-04."""
    df = segments.numbered(index(spark, sf), ["recording_id"], ["seg_no"], "place")
    return df.select("recording_id", "seg_no", F.col("place").cast("bigint").alias("place"), F.concat("recording_id", F.lit("No"), "place", F.lit(".wav")).alias("clip"))


@query("segment_ends", f"""SELECT recording_id, seg_no, {ms_sql('start_code')} AS start_ms, lead({ms_sql('start_code')}) OVER (PARTITION BY recording_id ORDER BY seg_no) AS end_ms FROM {INDEX_SQL}""")
def segment_ends(spark: SparkSession, sf: str) -> DataFrame:
    """W-03: a segment ends where the next begins."""
    df = index(spark, sf).select("recording_id", "seg_no", code_ms(F.col("start_code")).alias("start_ms"))
    return segments.with_ends(df, ["recording_id"], ["seg_no"], "start_ms", "end_ms")


_LINK = f"""i AS (SELECT * FROM {INDEX_SQL}),
l AS (SELECT i.recording_id, i.seg_no, i.text, (SELECT max(x.seg_no) FROM i x WHERE x.recording_id = i.recording_id AND replace(x.cont, ',', '.') = replace(i.start_code, ',', '.')) AS prev FROM i)"""


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    dots = index(spark, sf).withColumn("start_code", F.replace("start_code", F.lit(","), F.lit("."))).withColumn("cont", F.replace("cont", F.lit(","), F.lit(".")))
    return segments.link_continuations(dots, "recording_id", "seg_no", "start_code", "cont").select("recording_id", "seg_no", "text", "prev")


@query("continuation_links", f"WITH {_LINK} SELECT recording_id, seg_no, prev, prev IS NULL AS is_root FROM l")
def continuation_links(spark: SparkSession, sf: str) -> DataFrame:
    """J-01, D-02, F-08: self-join of continuation codes with start codes."""
    return _linked(spark, sf).select("recording_id", "seg_no", "prev", F.col("prev").isNull().alias("is_root"))


@query(
    "continuation_chains",
    f"""WITH RECURSIVE {_LINK},
p AS (SELECT recording_id, seg_no, text, CASE WHEN prev < seg_no THEN prev END AS prev FROM l),
w AS (SELECT recording_id, seg_no, seg_no AS root FROM p WHERE prev IS NULL UNION ALL SELECT p.recording_id, p.seg_no, w.root FROM p JOIN w ON p.recording_id = w.recording_id AND p.prev = w.seg_no)
SELECT w.recording_id, w.root AS seg_no, string_agg(coalesce(p.text, ''), ' ' ORDER BY p.seg_no) AS text, string_agg(CAST(p.seg_no AS VARCHAR), ',' ORDER BY p.seg_no) AS members
FROM w JOIN p USING (recording_id, seg_no) GROUP BY w.recording_id, w.root""",
)
def continuation_chains(spark: SparkSession, sf: str) -> DataFrame:
    """J-02, A-11, O-03: chains of continuations collapsed into their roots."""
    return segments.merged_chains(_linked(spark, sf), "recording_id", "seg_no", "prev", "text")


@query(
    "zip_transcripts",
    f"""WITH a AS (SELECT recording_id, seg_no, start_code, row_number() OVER (PARTITION BY recording_id ORDER BY trans DESC NULLS LAST, start_code NULLS LAST, seg_no) AS n FROM {INDEX_SQL}),
b AS (SELECT recording_id, transcript_id, row_number() OVER (PARTITION BY recording_id ORDER BY transcript_id) AS n FROM transcripts)
SELECT a.recording_id, a.seg_no, b.transcript_id FROM a LEFT JOIN b USING (recording_id, n)""",
)
def zip_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """J-03, O-02: positional join of index rows, transcribed ones first, with transcripts."""
    left, right = index(spark, sf), read_table(spark, sf, "transcripts")
    order = [F.col("trans").desc_nulls_last(), F.col("start_code").asc_nulls_last(), F.col("seg_no")]
    return segments.zip_join(left, right, ["recording_id"], order, [F.col("transcript_id")], ["transcript_id"]).select("recording_id", "seg_no", "transcript_id")


@query("clips_without_srt", f"SELECT recording_id, seg_no, regexp_replace(name, '\\.[^.]*$', '.srt') AS srt_name FROM {INDEX_SQL} i WHERE NOT EXISTS (SELECT 1 FROM srt_segments s WHERE s.recording_id = i.recording_id AND s.seg_file_no = i.seg_no)")
def clips_without_srt(spark: SparkSession, sf: str) -> DataFrame:
    """F-09, J-04, J-14, S-14, T-18: clips whose subtitles are missing."""
    files = read_table(spark, sf, "srt_segments").select("recording_id", F.col("seg_file_no").alias("seg_no"))
    return segments.missing(index(spark, sf), files, ["recording_id", "seg_no"]).select("recording_id", "seg_no", segments.srt_name(F.col("name")).alias("srt_name"))


@query("clips_with_both", f"SELECT recording_id, seg_no FROM {INDEX_SQL} i WHERE EXISTS (SELECT 1 FROM srt_segments s WHERE s.recording_id = i.recording_id AND s.seg_file_no = i.seg_no) AND EXISTS (SELECT 1 FROM manual_segments m WHERE m.recording_id = i.recording_id AND m.seg_no = i.seg_no)")
def clips_with_both(spark: SparkSession, sf: str) -> DataFrame:
    """J-14, J-16: clips of which both texts exist."""
    files = read_table(spark, sf, "srt_segments").select("recording_id", F.col("seg_file_no").alias("seg_no"))
    some = segments.used(index(spark, sf), files, ["recording_id", "seg_no"])
    return segments.used(some, read_table(spark, sf, "manual_segments"), ["recording_id", "seg_no"]).select("recording_id", "seg_no")


@query(
    "speaker_stats",
    f"""SELECT recording_id, speaker_tag, count(*) AS blocks, count(*) FILTER (WHERE e > s) AS timed, CAST(sum(CASE WHEN e > s THEN e - s END) AS BIGINT) AS speech_ms,
  CAST(sum(len(string_split({squeeze_sql("text")}, ' '))) AS BIGINT) AS words
FROM (SELECT *, {ms_sql('start_code')} AS s, {ms_sql('end_code')} AS e FROM {SRT_SQL}) WHERE speaker_tag <> '' AND text IS NOT NULL GROUP BY ALL""",
)
def speaker_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A-03, D-01: blocks, timed blocks, speech and words by recording and tag."""
    s, e = code_ms(F.col("start_code")), code_ms(F.col("end_code"))
    df = srt(spark, sf).where("speaker_tag <> '' AND text IS NOT NULL").select("recording_id", "speaker_tag", s.alias("s"), e.alias("e"), F.size(F.split(T.squeeze(F.col("text")), " ")).alias("w"))
    return df.groupBy("recording_id", "speaker_tag").agg(F.count("*").alias("blocks"), F.count_if(F.col("e") > F.col("s")).alias("timed"), F.sum(F.when(F.col("e") > F.col("s"), F.col("e") - F.col("s"))).alias("speech_ms"), F.sum("w").alias("words"))


# Patterns of the normalisers in DuckDB's syntax.
_BACKSLASH = r"\\"
_BRACKETS = r"\[[^\]]*\]"
_CODES = r"[0-9]{2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3}"
_ASCII_MARKS = r"[!-/:-@\[-`{-~]"
_MATCH_MARKS = r'[.,!?;:—"()…]'
_STRESS = r"[\\\x{0300}-\x{0304}]"
_EDIT_MARKS = r"[.,!?;:—–-]+"
_MARKS = r"\p{Mn}"
_TOKEN_MARKS = r"""[.,!?…—–:;()\[\]"''«»]"""


def _norm_reorder_sql(x: str) -> str:
    plain = gsub(gsub(f"coalesce({x}, '')", _BRACKETS, " "), _BACKSLASH)
    return f"lower({squeeze_sql(gsub(gsub(plain, _CODES, ' '), _ASCII_MARKS, ' '))})"


def _norm_match_sql(x: str) -> str:
    return f"lower({squeeze_sql(gsub(gsub(x, _BACKSLASH), _MATCH_MARKS, ' '))})"


def _norm_edit_sql(x: str) -> str:
    return squeeze_sql(gsub(gsub(f"lower({gsub(x, _STRESS)})", "_"), _EDIT_MARKS, " "))


def _clean_sql(x: str) -> str:
    return squeeze_sql(gsub(gsub(x, _STRESS), "_"))


def _without_marks() -> tuple[str, str]:
    """Letters that are composed of one letter and marks, and those letters, of the scripts in which there are any."""
    pairs = {}
    for a, z in ((0xC0, 0x24F), (0x370, 0x52F), (0x600, 0x6FF), (0x900, 0x97F), (0x1E00, 0x1FFF), (0x3040, 0x30FF)):
        for c in map(chr, range(a, z + 1)):
            base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
            if base != c and len(base) == 1:
                pairs[c] = base
    return "".join(pairs), "".join(pairs.values())


_COMPOSED, _BASES = _without_marks()


def _norm_tokens_sql(x: str) -> str:
    plain = f"translate(nfc_normalize(translate({gsub(x, _BACKSLASH)}, 'ёЁ', 'еЕ')), '{_COMPOSED}', '{_BASES}')"
    return squeeze_sql(gsub(f"lower({gsub(plain, _MARKS)})", _TOKEN_MARKS, " "))


_N = {"norm_reorder": _norm_reorder_sql, "norm_match": _norm_match_sql, "norm_edit": _norm_edit_sql, "clean_for_matching": _clean_sql}


def _norm_query(name: str):
    @query(f"text_{name}", f"SELECT recording_id, seg_no, pos, {_N[name]('text')} AS norm FROM {MANUAL_SQL}")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return manual(spark, sf).select("recording_id", "seg_no", "pos", getattr(T, name)(F.col("text")).alias("norm"))

    run.__doc__ = getattr(T, name).__doc__


for _name in _N:
    _norm_query(_name)


@query("text_norm_tokens", f"SELECT recording_id, seg_no, pos, {_norm_tokens_sql('text')} AS norm FROM {MANUAL_SQL}")
def text_norm_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """N-4: the form in which tokens are matched."""
    return manual(spark, sf).select("recording_id", "seg_no", "pos", T.norm_tokens(F.col("text")).alias("norm"))


@query(
    "srt_render",
    f"""SELECT recording_id, seg_file_no, string_agg(srt_index || chr(10) || start_code || ' --> ' || end_code || chr(10) || CASE WHEN coalesce(speaker_tag, '') <> '' THEN speaker_tag || ' ' ELSE '' END || coalesce(text, ''), chr(10) || chr(10) ORDER BY srt_index) AS srt
FROM {SRT_SQL} WHERE start_code IS NOT NULL AND end_code IS NOT NULL GROUP BY ALL""",
)
def srt_render(spark: SparkSession, sf: str) -> DataFrame:
    """K-07, K-08, A-11: the subtitle text of every clip."""
    return render_srt(srt(spark, sf).where("start_code IS NOT NULL AND end_code IS NOT NULL"), CLIP, "srt_index")


def _reparse(name: str, rules: Rules, tag: str, no_tag: str) -> None:
    """A query of one reader, with SQL that splits the same texts into blocks and lines by that reader's rules."""
    code = (lambda c: f"replace({c}, ',', '.')") if rules.dots else (lambda c: c)
    times = r"^\s*(.*?)\s*-->\s*(.*?)\s*$" if rules.any_times else r"([0-9]{2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3})\s*-->\s*([0-9]{2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3})"
    first = r"list_position(list_transform(w, lambda x: regexp_full_match(x, '\s*[0-9]+\s*')), true)"
    lines = f"CASE WHEN {first} > 1 THEN w[{first}:] ELSE w END" if rules.skip_lines else "w"
    index = r"WHEN NOT regexp_full_match(l[1], '\s*[0-9]+\s*') THEN 'index'" if rules.needs_index else ""

    @query(
        f"srt_parse_{name}",
        rf"""WITH r AS (SELECT recording_id, seg_file_no, string_agg(srt_index || CASE WHEN start_code IS NOT NULL AND end_code IS NOT NULL THEN chr(10) || start_code || ' --> ' || end_code ELSE '' END
    || chr(10) || CASE WHEN trim(coalesce(speaker_tag, '')) <> '' THEN trim(speaker_tag) || ' ' ELSE '' END || coalesce(text, ''), chr(10) || chr(10) ORDER BY srt_index) AS s FROM {SRT_SQL} GROUP BY ALL),
b AS (SELECT recording_id, seg_file_no, unnest(regexp_split_to_array(regexp_replace(regexp_replace(s, '\r\n?', chr(10), 'g'), '\s+$', ''), '{r"\n\s*\n" if rules.by_blank_lines else r"\n\n+"}')) AS b, generate_subscripts(regexp_split_to_array(regexp_replace(regexp_replace(s, '\r\n?', chr(10), 'g'), '\s+$', ''), '{r"\n\s*\n" if rules.by_blank_lines else r"\n\n+"}'), 1) - 1 AS block_no FROM r),
k AS (SELECT *, string_split(b, chr(10)) AS w FROM b), m AS (SELECT *, {lines} AS l FROM k),
t AS (SELECT *, regexp_matches(coalesce(l[2], ''), '{times}') AS timed, coalesce(l[3], '') AS head FROM m)
SELECT recording_id, seg_file_no, CAST(block_no AS INT) AS block_no, try_cast(trim(l[1]) AS INT) AS srt_index, CASE WHEN l[2] IS NOT NULL THEN {code(f"regexp_extract(l[2], '{times}', 1)")} END AS start_code, CASE WHEN l[2] IS NOT NULL THEN {code(f"regexp_extract(l[2], '{times}', 2)")} END AS end_code,
  CASE WHEN regexp_matches(head, '{tag}') THEN regexp_extract(head, '{tag}', 1) ELSE {no_tag} END AS tag,
  CASE {index} WHEN len(l) < {rules.least_lines} THEN 'lines' WHEN NOT timed THEN 'time' END AS bad
FROM t""",
    )
    def run(spark: SparkSession, sf: str) -> DataFrame:
        whole = srt(spark, sf).withColumn("speaker_tag", F.trim("speaker_tag"))
        parsed = parse_blocks(render_srt(whole, CLIP, "srt_index"), "srt", replace(rules, strict=True))
        return parsed.select(*CLIP, "block_no", "srt_index", "start_code", "end_code", F.col("speaker_tag").alias("tag"), "bad")

    run.__doc__ = f"Section 2.9: the text of every clip written and read again by the rules of {name}; bad names what is wrong with a block."


_SPEAKER, _ANY_TAG, _ANY_NAME = r"^\s*\[(SPEAKER_[0-9]+)\]:", r"^\s*(\[[^\]]+\]:)", r"^\s*\[([^\]]+)\]:"
_reparse("merge", MERGE, _SPEAKER, "NULL")
_reparse("span", SPAN, _ANY_TAG, "''")
_reparse("embed", EMBED, _SPEAKER, "'UNKNOWN'")
_reparse("cut", CUT, _ANY_NAME, "'UNKNOWN'")


@query(
    "bracket_parts",
    f"""WITH p AS (SELECT recording_id, seg_no, pos, string_split(regexp_replace(text, '(\\[[^\\n]*?\\])', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS ps FROM {MANUAL_SQL}),
u AS (SELECT recording_id, seg_no, pos, {strip_sql('unnest(ps)')} AS x, generate_subscripts(ps, 1) AS k FROM p),
c AS (SELECT *, regexp_full_match(x, '(?s)\\[.*\\]') AS inside FROM u WHERE x <> ''),
d AS (SELECT *, CASE WHEN inside THEN {strip_sql('substr(x, 2, length(x) - 2)')} ELSE x END AS said FROM c)
SELECT recording_id, seg_no, pos, CAST(row_number() OVER (PARTITION BY recording_id, seg_no, pos ORDER BY k) AS INT) AS part, said, NOT inside AS is_dialect
FROM d WHERE NOT (inside AND (said = '' OR starts_with(said, '…') OR starts_with(said, 'Соб.')))""",
)
def bracket_parts(spark: SparkSession, sf: str) -> DataFrame:
    """T-09, F-10, F-14: what is within and without square brackets."""
    parts = manual(spark, sf).select("recording_id", "seg_no", "pos", F.posexplode(T.bracket_parts(F.col("text"))).alias("part", "x"))
    return parts.select("recording_id", "seg_no", "pos", (F.col("part") + 1).alias("part"), F.col("x.text").alias("said"), F.col("x.is_dialect").alias("is_dialect"))


_BLANKS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}]+"


@query(
    "sentence_split",
    f"""WITH s AS (SELECT transcript_id, string_split(regexp_replace(transcript, '([.!?]){_BLANKS}', '\\1' || chr(1), 'g'), chr(1)) AS xs FROM transcripts WHERE transcript IS NOT NULL)
SELECT transcript_id, CAST(generate_subscripts(xs, 1) - 1 AS INT) AS pos, unnest(xs) AS sentence FROM s""",
)
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    """T-05, T-06: the sentences of the plain splitter at marks and blanks."""
    parts = read_table(spark, sf, "transcripts").where("transcript IS NOT NULL").select("transcript_id", T.split_marks(F.col("transcript")).alias("xs"))
    return parts.select("transcript_id", F.posexplode("xs").alias("pos", "sentence"))


_PACKED_SQL = f"""WITH RECURSIVE u AS (SELECT transcript_id, {strip_sql("unnest(regexp_split_to_array(transcript, '[.!?]+'))")} AS x, unnest(range(len(regexp_split_to_array(transcript, '[.!?]+')))) AS k FROM transcripts WHERE transcript IS NOT NULL),
p AS (SELECT transcript_id, x, row_number() OVER (PARTITION BY transcript_id ORDER BY k) AS k, len(regexp_split_to_array(x, '{_BLANKS}')) AS n FROM u WHERE x <> ''),
f AS (SELECT transcript_id, x, k, n AS now, 1 AS seg FROM p WHERE k = 1
  UNION ALL SELECT p.transcript_id, p.x, p.k, CASE WHEN f.now + p.n > 30 OR f.now >= 5 THEN p.n ELSE f.now + p.n END, CASE WHEN f.now + p.n > 30 OR f.now >= 5 THEN f.seg + 1 ELSE f.seg END FROM f JOIN p ON p.transcript_id = f.transcript_id AND p.k = f.k + 1),
s AS (SELECT transcript_id, seg, string_agg(x, ' ' ORDER BY k) AS orig FROM f GROUP BY ALL),
c AS (SELECT transcript_id, seg, orig, {_clean_sql('orig')} AS clean FROM s),
d AS (SELECT transcript_id, orig, clean, row_number() OVER (PARTITION BY transcript_id ORDER BY seg) AS k, len(string_split(clean, ' ')) AS n FROM c WHERE clean <> ''),
j AS (SELECT transcript_id, orig, clean, k, n < 3 AS held, 0 AS pos FROM d WHERE k = 1
  UNION ALL SELECT d.transcript_id, d.orig, d.clean, d.k, NOT j.held AND d.n < 3, CASE WHEN j.held THEN j.pos ELSE j.pos + 1 END FROM j JOIN d ON d.transcript_id = j.transcript_id AND d.k = j.k + 1)
SELECT transcript_id, CAST(pos AS INT) AS pos, string_agg(orig, ' ' ORDER BY k) AS orig, string_agg(clean, ' ' ORDER BY k) AS clean FROM j GROUP BY transcript_id, pos"""


@query("packed_sentences", _PACKED_SQL)
def packed_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """T-07, T-08, W-08, W-09: transcripts packed into segments, short ones joined to the next."""
    packed = read_table(spark, sf, "transcripts").select("transcript_id", T.joined_short(T.packed_sentences(F.col("transcript"))).alias("xs"))
    return packed.select("transcript_id", F.posexplode("xs").alias("pos", "x")).select("transcript_id", "pos", "x.orig", "x.clean")


_LABEL_SQL = r"^\[([A-Za-zА-Яа-яЁё.?]{1,8})\s?:"
_PREPARED_SQL = rf"""WITH m AS (SELECT recording_id, seg_no, pos, string_split(regexp_replace(text, '(\[[^\]]+\])', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS ps FROM {MANUAL_SQL} WHERE text IS NOT NULL),
u AS (SELECT recording_id, seg_no, pos, unnest(ps) AS x, generate_subscripts(ps, 1) AS a FROM m),
v AS (SELECT *, CASE WHEN regexp_full_match(x, '\[[^\]]+\]') THEN [x] ELSE string_split(regexp_replace(x, '([.!?]){_BLANKS}', '\1' || chr(2), 'g'), chr(2)) END AS ys FROM u),
w AS (SELECT recording_id, seg_no, pos, a, {strip_sql('unnest(ys)')} AS y, generate_subscripts(ys, 1) AS b FROM v),
n AS (SELECT *, regexp_full_match(y, '\[[^\]]+\]') AS bare, regexp_full_match(y, '\[[A-Za-zА-Яа-яЁё.?]{{1,8}}\s?:\s*\]') AS label FROM w WHERE y <> ''),
o AS (SELECT *, lead(y) OVER q AS next, coalesce(label AND NOT lead(bare) OVER q, false) AS takes, row_number() OVER q AS k FROM n WINDOW q AS (PARTITION BY recording_id, seg_no, pos ORDER BY a, b)),
t AS (SELECT *, coalesce(lag(takes) OVER (PARTITION BY recording_id, seg_no, pos ORDER BY k), false) AS taken FROM o),
f AS (SELECT recording_id, seg_no, pos, k, CASE WHEN takes THEN y || ' ' || next ELSE y END AS orig FROM t WHERE NOT taken)
SELECT recording_id, seg_no, pos, CAST(row_number() OVER (PARTITION BY recording_id, seg_no, pos ORDER BY k) - 1 AS INT) AS part, orig,
  {_norm_match_sql(rf"CASE WHEN regexp_full_match(orig, '\[[^\]]+\]') THEN regexp_replace(orig, '\[[^\]]*\]', '', 'g') ELSE orig END")} AS norm,
  CASE WHEN regexp_matches(orig, '{_LABEL_SQL}') THEN regexp_extract(orig, '{_LABEL_SQL}', 1) || ':' END AS label,
  {squeeze_sql(rf"CASE WHEN regexp_matches(orig, '{_LABEL_SQL}') THEN regexp_replace(orig, '(?s)^\[[A-Za-zА-Яа-яЁё.?]{{1,8}}\s?:\s*([^\]]*)\]\s*(.*)$', '\1 \2') ELSE regexp_replace(orig, '(?s)^\[(.*)\]$', '\1') END")} AS said
FROM f"""


@query("prepared_segments", _PREPARED_SQL)
def prepared_segments(spark: SparkSession, sf: str) -> DataFrame:
    """T-10, T-11, W-10: segments of hand-made lines with labels and forms for matching."""
    parts = manual(spark, sf).select("recording_id", "seg_no", "pos", F.posexplode(T.prepared_segments(F.col("text"))).alias("part", "x"))
    return parts.select("recording_id", "seg_no", "pos", "part", "x.orig", "x.norm", T.label_of(F.col("x.orig")).alias("label"), T.without_label(F.col("x.orig")).alias("said"))


@query(
    "token_offsets",
    f"""WITH w AS (SELECT transcript_id, regexp_extract_all(transcript, '[^\\s\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+') AS ws,
  regexp_extract_all(transcript, '[\\s\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]*[^\\s\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+') AS xs FROM transcripts WHERE transcript IS NOT NULL),
u AS (SELECT transcript_id, unnest(ws) AS text, unnest(xs) AS x, generate_subscripts(xs, 1) - 1 AS pos FROM w),
e AS (SELECT *, CAST(sum(length(x)) OVER (PARTITION BY transcript_id ORDER BY pos) AS INT) AS ends FROM u)
SELECT transcript_id, CAST(pos AS INT) AS pos, text, {_norm_tokens_sql("CASE WHEN starts_with(text, '[') AND ends_with(text, ']') THEN CASE WHEN length(text) > 1 THEN substr(text, 2, length(text) - 2) ELSE '' END ELSE text END")} AS norm, CAST(ends - length(text) AS INT) AS start_char, ends AS end_char FROM e""",
)
def token_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """T-13, T-14, W-11: all tokens of all transcripts, with their norms and offsets."""
    cut = read_table(spark, sf, "transcripts").select("transcript_id", F.posexplode(T.tokens_with_offsets(F.col("transcript"))).alias("pos", "x"))
    return cut.select("transcript_id", "pos", "x.text", "x.norm", F.col("x.start").alias("start_char"), F.col("x.end").alias("end_char"))


# DuckDB's levenshtein counts bytes, so characters beyond ASCII that occur are put as single ones that don't.
_WIDE_LETTERS = "абвгдежзийклмнопрстуфхцчшщъыьэюяё" + "…♪«»“”„’№°—–\u0306\u0308é"
_BYTES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(map(chr, (*range(1, 9), *range(14, 32))))


def _bytes_sql(x: str) -> str:
    """A text with one byte for each character."""
    to = " || ".join(f"chr({ord(c)})" for c in _BYTES[: len(_WIDE_LETTERS)])
    return f"translate({x}, '{_WIDE_LETTERS}', {to})"


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Hand-made and recognised lines of the same clips, in the form for edit distances."""
    a = manual(spark, sf).select("recording_id", "seg_no", F.col("pos").alias("l_pos"), T.norm_edit(F.col("text")).alias("l_norm"))
    b = srt(spark, sf).select("recording_id", F.col("seg_file_no").alias("seg_no"), F.col("srt_index").alias("r_pos"), T.norm_edit(F.col("text")).alias("r_norm"))
    return a.where("l_norm <> ''"), b.where("r_norm <> ''")


_SIDES_SQL = f"""a AS (SELECT recording_id, seg_no, pos AS l_pos, {_N['norm_edit']('text')} AS l_norm FROM {MANUAL_SQL}),
b AS (SELECT recording_id, seg_file_no AS seg_no, srt_index AS r_pos, {_N['norm_edit']('text')} AS r_norm FROM {SRT_SQL})"""


@query(
    "edit_matches",
    f"""WITH {_SIDES_SQL},
x AS (SELECT recording_id, seg_no, l_pos, {_bytes_sql('l_norm')} AS l FROM a WHERE l_norm <> ''), y AS (SELECT recording_id, seg_no, r_pos, {_bytes_sql('r_norm')} AS r FROM b WHERE r_norm <> ''),
p AS (SELECT recording_id, seg_no, l_pos, r_pos, 1 - levenshtein(l, r) / greatest(length(l), length(r)) AS sim FROM x JOIN y USING (recording_id, seg_no))
SELECT recording_id, seg_no, l_pos, first(r_pos ORDER BY sim DESC, r_pos) AS r_pos, round(max(sim), 9) AS sim FROM p WHERE sim >= 0.5 GROUP BY ALL""",
)
def edit_matches(spark: SparkSession, sf: str) -> DataFrame:
    """J-06, M-02, O-06, F-12: the most similar recognised line of each hand-made one by edit distance."""
    a, b = _sides(spark, sf)
    found = segments.best_matches(a, b, ["recording_id", "seg_no"], 0.5)
    return found.withColumn("sim", F.round("sim", 9))


@query(
    "dice_matches",
    f"""WITH {_SIDES_SQL},
p AS (SELECT recording_id, seg_no, l_pos, r_pos, 2.0 * len(list_intersect(string_split(l_norm, ' '), string_split(r_norm, ' '))) / (len(list_distinct(string_split(l_norm, ' '))) + len(list_distinct(string_split(r_norm, ' ')))) AS sim
  FROM a JOIN b USING (recording_id, seg_no) WHERE l_norm <> '' AND r_norm <> '')
SELECT recording_id, seg_no, l_pos, first(r_pos ORDER BY sim DESC, r_pos) AS r_pos, round(max(sim), 9) AS sim FROM p WHERE sim >= 0.3 GROUP BY ALL""",
)
def dice_matches(spark: SparkSession, sf: str) -> DataFrame:
    """M-01, J-06, U-04: the most similar line by shared words."""
    a, b = _sides(spark, sf)
    found = segments.best_matches(a.withColumn("l_norm", F.split("l_norm", " ")), b.withColumn("r_norm", F.split("r_norm", " ")), ["recording_id", "seg_no"], 0.3, by="dice")
    return found.withColumn("sim", F.round("sim", 9))


@query("fuzzy_ratios")
def fuzzy_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """M-03, M-04: word-set and partial ratios of each hand-made line with the recognised line of its place."""
    a, b = _sides(spark, sf)
    met = a.join(b.withColumnRenamed("r_pos", "l_pos"), ["recording_id", "seg_no", "l_pos"])
    scored = met.select("recording_id", "seg_no", "l_pos", S.strict_scores_udf("l_norm", "r_norm").alias("x"), S.loose_scores_udf("l_norm", "r_norm").alias("y"))
    whole = scored.select("recording_id", "seg_no", "l_pos", F.col("x.words").alias("strict_words"), F.col("x.part").alias("strict_part"), F.col("y.words").alias("words"), F.col("y.part").alias("part"))
    return whole.withColumn("strict", (F.col("strict_words") > 90) | (F.col("strict_part") > 90)).withColumn("loose", (F.col("words") >= 50) | (F.col("part") >= 60))


@query("greedy_runs")
def greedy_runs(spark: SparkSession, sf: str) -> DataFrame:
    """J-08: recognised lines take runs of hand-made ones, with look-ahead."""
    a, b = _sides(spark, sf)
    left, right = b.withColumnsRenamed({"r_pos": "l_pos", "r_norm": "l_norm"}), a.withColumnsRenamed({"l_pos": "r_pos", "l_norm": "r_norm"})
    return matching.aligned(left, right, ["recording_id", "seg_no"], matching.greedy_run)


@query("greedy_pointers")
def greedy_pointers(spark: SparkSession, sf: str) -> DataFrame:
    """J-09: recognised lines take hand-made ones from a pointer on."""
    a, b = _sides(spark, sf)
    left, right = b.withColumnsRenamed({"r_pos": "l_pos", "r_norm": "l_norm"}), a.withColumnsRenamed({"l_pos": "r_pos", "l_norm": "r_norm"})
    return matching.aligned(left, right, ["recording_id", "seg_no"], matching.greedy_pointer)


def _token_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    left = srt(spark, sf).select("recording_id", F.col("seg_file_no").alias("seg_no"), F.col("srt_index").alias("l_pos"), T.norm_tokens(F.col("text")).alias("l_norm"))
    tokens = manual(spark, sf).select("recording_id", "seg_no", "pos", F.posexplode(F.split(T.norm_tokens(F.col("text")), " ")).alias("k", "r_norm"))
    return left, tokens.select("recording_id", "seg_no", (F.col("pos").cast("bigint") * F.lit(1 << 32) + F.col("k")).alias("r_pos"), "r_norm")


@query("span_matches")
def span_matches(spark: SparkSession, sf: str) -> DataFrame:
    """J-10, A-07: the cheapest monotone spans of transcript tokens for recognised lines."""
    left, right = _token_sides(spark, sf)
    return matching.span_aligned(left, right, ["recording_id", "seg_no"]).withColumn("cost", F.round("cost", 6))


@query("best_parameters")
def best_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """A-08: the parameters that leave fewest lines without tokens, of the reference's grid of 27 in its order."""
    left, _ = _token_sides(spark, sf)
    right = manual(spark, sf).select("recording_id", "seg_no", F.col("pos").alias("r_pos"), T.norm_tokens(F.col("text")).alias("r_norm")).where("r_norm IS NOT NULL")
    grid = [{"skip": s, "least": t, "length_cost": c, "longest": 15} for s in (0.5, 0.8, 1.0) for t in (0.2, 0.3, 0.4) for c in (0.01, 0.02, 0.05)]
    return matching.best_parameters(left, right, ["recording_id", "seg_no"], grid)


def _reorder_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Index lines with the transcript that stands at their number."""
    texts = read_table(spark, sf, "transcripts").groupBy("recording_id", "seg_no").agg(F.min_by("transcript", "transcript_id").alias("transcript"))
    return index(spark, sf).select("recording_id", "seg_no", "text", "trans").join(texts, ["recording_id", "seg_no"], "left")


@query(
    "char_tfidf",
    f"""WITH d AS (SELECT recording_id, seg_no, {_N['norm_reorder']('text')} AS a FROM {INDEX_SQL}),
t AS (SELECT recording_id, seg_no, {_N['norm_reorder']('min_by(transcript, transcript_id)')} AS b FROM transcripts GROUP BY recording_id, seg_no),
r AS (SELECT d.recording_id, d.seg_no, a, coalesce(b, '') AS b FROM d LEFT JOIN t USING (recording_id, seg_no)),
u AS (SELECT recording_id, 0 AS side, seg_no, a AS x FROM r UNION ALL SELECT recording_id, 1, seg_no, b FROM r),
g AS (SELECT recording_id, side, seg_no, substr(x, i, n) AS gram, count(*) AS c FROM (SELECT u.*, k.n, unnest(range(1, length(x) - k.n + 2)) AS i FROM u, (VALUES (3), (4), (5)) k(n)) GROUP BY ALL),
f AS (SELECT recording_id, gram, count(*) AS df, sum(c) AS total FROM g GROUP BY ALL),
q AS (SELECT *, rank() OVER (PARTITION BY recording_id ORDER BY total DESC) AS above FROM f),
v AS (SELECT * FROM q WHERE above <= 20000),
n AS (SELECT recording_id, count(*) AS docs FROM u GROUP BY ALL),
w AS (SELECT g.recording_id, side, seg_no, gram, c * (ln((1 + docs) / (1 + df)) + 1) AS w FROM g JOIN v USING (recording_id, gram) JOIN n USING (recording_id)),
l AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY recording_id, side, seg_no)) AS z FROM w)
SELECT a.recording_id, a.seg_no AS i, b.seg_no AS j, round(sum(a.z * b.z), 6) AS cosine FROM l a JOIN l b ON a.recording_id = b.recording_id AND a.gram = b.gram AND a.side = 0 AND b.side = 1 GROUP BY ALL""",
)
def char_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """M-05, first part: cosines of character n-grams of index lines and transcripts."""
    rows = _reorder_rows(spark, sf)
    side = lambda k, c: rows.select("recording_id", F.lit(k).alias("side"), "seg_no", T.norm_reorder(F.col(c)).alias("x"))
    found = reorder.matrix(side(0, "text").unionByName(side(1, "transcript")), "recording_id", "side", "seg_no", "x", words=False)
    return found.select("recording_id", F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), F.round("cosine", 6).alias("cosine"))


@query("shift_detected")
def shift_detected(spark: SparkSession, sf: str) -> DataFrame:
    """A-01, A-02, M-05: the shift at which the active index lines and transcripts of a recording fit best, by place."""
    placed = stage(reorder._placed(_reorder_rows(spark, sf), "recording_id", "seg_no", "text", "transcript", "trans"))
    return reorder.best_shift(reorder.diagonals(placed, "recording_id"), "recording_id").withColumn("mean_sim", F.round("mean_sim", 6))


@query("transcripts_reordered")
def transcripts_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """J-05, J-07, M-09, U-01, U-02, W-06, stage 5: transcripts put back to the segments they fit."""
    return reorder.reordered(_reorder_rows(spark, sf), "recording_id", "seg_no", "text", "transcript", "trans")[0]


@query("reorder_summary")
def reorder_summary(spark: SparkSession, sf: str) -> DataFrame:
    """K-16, M-09: for each recording the shift, the mean similarity before and after, and whether anything was moved."""
    return reorder.reordered(_reorder_rows(spark, sf), "recording_id", "seg_no", "text", "transcript", "trans")[1]


@query(
    "embedding_band",
    """WITH v AS (SELECT label, vec_id, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS p FROM embeddings)
SELECT a.label, a.p AS i, b.p AS j, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS sim
FROM v a JOIN v b ON a.label = b.label AND abs(a.p - b.p) <= 5 WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.5""",
)
def embedding_band(spark: SparkSession, sf: str) -> DataFrame:
    """J-11, M-06, M-07, F-12: pairs of vectors of near places whose cosine is 0.5 or more."""
    v = segments.numbered(read_table(spark, sf, "embeddings"), ["label"], ["vec_id"], "p").select("label", "p", "embedding")
    pairs = segments.banded_pairs(v, "label", "p", "embedding", v)
    scored = pairs.select("label", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), S.cosine(F.col("a"), F.col("b")).alias("sim"))
    return scored.where("sim >= 0.5").withColumn("sim", F.round("sim", 6))


_CLIP_SECONDS = f"SELECT recording_id, seg_file_no, max({ms_sql('end_code')}) / 1000.0 AS d FROM {SRT_SQL} GROUP BY ALL HAVING d IS NOT NULL"


def _clip_seconds(spark: SparkSession, sf: str) -> DataFrame:
    return srt(spark, sf).groupBy(*CLIP).agg((F.max(code_ms(F.col("end_code"))) / 1000.0).alias("d")).where("d IS NOT NULL")


@query(
    "duration_batches",
    f"""WITH RECURSIVE c AS ({_CLIP_SECONDS}), o AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY d, seg_file_no) AS n FROM c),
f AS (SELECT recording_id, seg_file_no, d, n, 0 AS batch_no, 0 AS place, d AS s FROM o WHERE n = 1
  UNION ALL SELECT o.recording_id, o.seg_file_no, o.d, o.n, CASE WHEN f.place + 1 >= 32 OR f.s + o.d > 180.0 THEN f.batch_no + 1 ELSE f.batch_no END,
    CASE WHEN f.place + 1 >= 32 OR f.s + o.d > 180.0 THEN 0 ELSE f.place + 1 END, CASE WHEN f.place + 1 >= 32 OR f.s + o.d > 180.0 THEN o.d ELSE f.s + o.d END
  FROM f JOIN o ON o.recording_id = f.recording_id AND o.n = f.n + 1)
SELECT recording_id, CAST(seg_file_no AS BIGINT) AS seg_file_no, CAST(d AS DOUBLE) AS d, batch_no, place FROM f""",
)
def duration_batches(spark: SparkSession, sf: str) -> DataFrame:
    """W-07, O-04: clips of each recording in batches of bounded number and length."""
    return batching.duration_batches(_clip_seconds(spark, sf), ["recording_id"], "seg_file_no", "d")


@query("batch_estimates", f"SELECT recording_id, CAST(greatest(ceil(sum(d) / 180.0), ceil(count(*) / 32.0), 1) AS BIGINT) AS batches FROM ({_CLIP_SECONDS}) GROUP BY ALL")
def batch_estimates(spark: SparkSession, sf: str) -> DataFrame:
    """A-10: how many batches a recording's clips need at least."""
    return batching.batch_estimate(_clip_seconds(spark, sf), ["recording_id"], "d").withColumn("batches", F.col("batches").cast("bigint"))


@query(
    "padded_tokens",
    """WITH t AS (SELECT transcript_id, transcript_id // 32 AS batch_no, list(end_char - start_char ORDER BY pos) AS xs FROM t2_tokens GROUP BY ALL), m AS (SELECT batch_no, max(len(xs)) AS n FROM t GROUP BY ALL)
SELECT transcript_id, batch_no, CAST(unnest(range(n)) AS INT) AS place, CAST(unnest(list_resize(xs, n, 0)) AS DOUBLE) AS value, unnest(list_transform(range(n), lambda i: i < len(xs))) AS is_real FROM t JOIN m USING (batch_no)""",
)
def padded_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """L-01, L-02: lengths of tokens, padded to the longest transcript of a batch, with the mask."""
    t = read_table(spark, sf, "t2_tokens").groupBy("transcript_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", (F.col("end_char") - F.col("start_char")).alias("x")))), lambda v: v["x"].cast("double")).alias("xs"))
    t = t.withColumn("batch_no", F.floor(F.col("transcript_id") / 32))
    size = t.groupBy(F.col("batch_no").alias("of")).agg(F.max(F.size("xs")).alias("n"))
    made = t.join(size, F.col("batch_no") == F.col("of"))
    both = F.arrays_zip(batching.padded(F.col("xs"), F.col("n")).alias("value"), batching.mask(F.col("xs"), F.col("n")).alias("is_real"))
    return made.select("transcript_id", "batch_no", F.posexplode(both).alias("place", "x")).select("transcript_id", "batch_no", "place", "x.value", "x.is_real")


@query("first_texts", "SELECT text, min(doc_id) AS doc_id, first(lang ORDER BY doc_id) AS lang FROM documents WHERE text IS NOT NULL GROUP BY text")
def first_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A-09: each text at its first place."""
    df = read_table(spark, sf, "documents").where("text IS NOT NULL").select("text", "doc_id", "lang")
    return segments.first_seen(df, ["text"], "doc_id")


@query(
    "distinct_sentences",
    f"SELECT recording_id, seg_no, {_N['norm_edit']('text')} AS norm, min(pos) AS pos, last(text ORDER BY pos) AS text FROM {MANUAL_SQL} WHERE text IS NOT NULL GROUP BY ALL".replace("GROUP BY ALL", f"GROUP BY recording_id, seg_no, {_N['norm_edit']('text')}"),
)
def distinct_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """A-14: one line per form, with its first place and its last spelling."""
    df = manual(spark, sf).where("text IS NOT NULL").withColumn("norm", T.norm_edit(F.col("text")))
    return segments.ordered_distinct(df, ["recording_id", "seg_no"], "norm", "text", "pos")


@query(
    "manifest_paths",
    """WITH m AS (SELECT recording_id, CASE WHEN duration_sec IS NULL THEN original_name ELSE CAST(json_object('path', original_name || original_extension, 'duration_s', duration_sec) AS VARCHAR) END AS line FROM audio_catalog)
SELECT recording_id, CASE WHEN starts_with(trim(line), '{') THEN json_extract_string(line, '$.path') ELSE nullif(trim(line), '') END AS path FROM m""",
)
def manifest_paths(spark: SparkSession, sf: str) -> DataFrame:
    """S-18, JS-01: paths of a manifest of plain and JSON lines."""
    row = F.to_json(F.struct(F.concat("original_name", "original_extension").alias("path"), F.col("duration_sec").alias("duration_s")))
    lines = read_table(spark, sf, "audio_catalog").select("recording_id", F.when(F.col("duration_sec").isNull(), F.col("original_name")).otherwise(row).alias("line"))
    return lines.select("recording_id", manifest.manifest_path(F.col("line")).alias("path"))


@query(
    "tolerant_bools",
    f"""SELECT recording_id, seg_no, CASE WHEN lower(trim(x)) IN ('true', '1', 'yes', 'y') THEN true WHEN lower(trim(x)) IN ('false', '0', 'no', 'n', '') THEN false ELSE coalesce(try_cast(lower(trim(x)) AS INT) <> 0, false) END AS active
FROM (SELECT recording_id, seg_no, coalesce(CAST(prev AS VARCHAR), CASE WHEN trans THEN ' Yes' ELSE 'off' END) AS x FROM {INDEX_SQL})""",
)
def tolerant_bools(spark: SparkSession, sf: str) -> DataFrame:
    """F-04, F-05: flags as people write them."""
    x = F.coalesce(F.col("prev").cast("string"), F.when(F.col("trans"), " Yes").otherwise("off"))
    return index(spark, sf).select("recording_id", "seg_no", T.tolerant_bool(x).alias("active"))


@query(
    "leftovers_appended",
    f"""SELECT recording_id, seg_no, CAST(NULL AS BIGINT) AS transcript_id FROM {INDEX_SQL}
UNION ALL BY NAME SELECT recording_id, NULL AS seg_no, transcript_id FROM transcripts t WHERE NOT EXISTS (SELECT 1 FROM index_segments i WHERE i.recording_id = t.recording_id AND i.seg_no = t.seg_no)""",
)
def leftovers_appended(spark: SparkSession, sf: str) -> DataFrame:
    """U-01, U-02, U-05: index rows, then transcripts that belong to none."""
    rows = index(spark, sf).select("recording_id", "seg_no")
    rest = segments.missing(read_table(spark, sf, "transcripts"), rows, ["recording_id", "seg_no"]).select("recording_id", "transcript_id")
    return rows.unionByName(rest, allowMissingColumns=True)


@query(
    "speaker_fill",
    f"""WITH s AS (SELECT recording_id, seg_file_no, srt_index, CASE WHEN starts_with(trim(speaker_tag), '[') THEN trim(speaker_tag) END AS e, CASE WHEN NOT starts_with(trim(coalesce(speaker_tag, '')), '[') THEN coalesce(nullif(trim(speaker_tag), ''), '?') END AS p FROM {SRT_SQL}),
w AS (SELECT *, last_value(e IGNORE NULLS) OVER (PARTITION BY recording_id, seg_file_no ORDER BY srt_index ROWS UNBOUNDED PRECEDING) AS le, first_value(p IGNORE NULLS) OVER (PARTITION BY recording_id, seg_file_no ORDER BY srt_index ROWS UNBOUNDED PRECEDING) AS fp FROM s)
SELECT recording_id, seg_file_no, srt_index, coalesce(le, fp) AS speaker FROM w""",
)
def speaker_fill(spark: SparkSession, sf: str) -> DataFrame:
    """W-05: explicit labels carried on; before the first of them the first placeholder."""
    tag = F.trim(F.coalesce("speaker_tag", F.lit("")))
    df = srt(spark, sf).select(*CLIP, "srt_index", F.when(tag.startswith("["), tag).alias("e"), F.when(~tag.startswith("["), F.when(tag == "", "?").otherwise(tag)).alias("p"))
    return segments.filled_speakers(df, CLIP, "srt_index", "e", "p").select(*CLIP, "srt_index", "speaker")


@query(
    "rotated_places",
    f"WITH n AS (SELECT recording_id, seg_no, row_number() OVER (PARTITION BY recording_id ORDER BY seg_no) - 1 AS p, count(*) OVER (PARTITION BY recording_id) AS k FROM {INDEX_SQL}) SELECT recording_id, seg_no, (p + k - 1) % k AS place FROM n",
)
def rotated_places(spark: SparkSession, sf: str) -> DataFrame:
    """W-06: each recording's list rotated by one."""
    df = segments.numbered(index(spark, sf), ["recording_id"], ["seg_no"], "p")
    size = index(spark, sf).groupBy("recording_id").agg(F.count("*").alias("k"))
    return df.join(size, "recording_id").select("recording_id", "seg_no", segments.rotated(F.col("p"), F.col("k"), F.lit(1)).alias("place"))


@query(
    "utterance_names",
    rf"""SELECT recording_id, seg_file_no, srt_index, format('{{:03d}}_', srt_index) || coalesce(nullif(regexp_extract(speaker_tag, '^\[(SPEAKER_[0-9]+)\]:$', 1), ''), 'UNKNOWN') || '_' || translate(replace(start_code, ',', '.'), ':.', '--') AS base
FROM {SRT_SQL} WHERE start_code IS NOT NULL""",
)
def utterance_names(spark: SparkSession, sf: str) -> DataFrame:
    """D-02, T-16, T-17, F-07: names of utterance files."""
    tag = F.regexp_extract("speaker_tag", r"^\[(SPEAKER_[0-9]+)\]:$", 1)
    speaker = F.coalesce(F.when(tag != "", tag), F.lit("UNKNOWN"))
    return srt(spark, sf).where("start_code IS NOT NULL").select(*CLIP, "srt_index", T.utterance_name(F.col("srt_index"), speaker, F.replace("start_code", F.lit(","), F.lit("."))).alias("base"))


@query(
    "clip_summary",
    f"""SELECT recording_id, seg_no, count_if(side = 'whisper') AS whisper_total, count_if(side = 'manual') AS manual_total, count_if(side = 'whisper' AND is_dialect) AS whisper_dialect, count_if(side = 'whisper' AND NOT is_dialect) AS whisper_standard,
  count_if(side = 'manual' AND is_dialect) AS manual_dialect, count_if(side = 'manual' AND NOT is_dialect) AS manual_standard
FROM (SELECT recording_id, seg_file_no AS seg_no, 'whisper' AS side, is_dialect FROM whisper_segments UNION ALL SELECT recording_id, seg_no, 'manual', is_dialect FROM {MANUAL_SQL}) GROUP BY ALL""",
)
def clip_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A-03, K-11: counts of both sides by clip."""
    heard = read_table(spark, sf, "whisper_segments").select("recording_id", F.col("seg_file_no").alias("seg_no"), F.lit("whisper").alias("side"), "is_dialect")
    made = manual(spark, sf).select("recording_id", "seg_no", F.lit("manual").alias("side"), "is_dialect")
    return sinks.run_summary(heard.unionByName(made), ["recording_id", "seg_no"])


_WORDS = "len(list_filter(string_split({}, ' '), lambda w: w <> ''))"
_DICE = "2.0 * len(list_intersect(string_split({0}, ' '), string_split({1}, ' '))) / (len(list_distinct(string_split({0}, ' '))) + len(list_distinct(string_split({1}, ' '))))"


@query(
    "pair_file",
    f"""WITH h AS (SELECT recording_id, seg_file_no AS seg_no, pos, text AS source, {squeeze_sql('text')} AS a FROM whisper_segments), m AS (SELECT recording_id, seg_no, pos, text AS target, {squeeze_sql('text')} AS b FROM {MANUAL_SQL}),
p AS (SELECT recording_id, seg_no, pos, source, target, {_DICE.format('a', 'b')} AS sim, {_WORDS.format('a')} AS x, {_WORDS.format('b')} AS y FROM h JOIN m USING (recording_id, seg_no, pos))
SELECT recording_id, seg_no, pos * 3 + k AS line_no, CASE k WHEN 0 THEN pos || '> ' || source WHEN 1 THEN pos || '= ' || target ELSE pos || '# ' || format('{{:.3f}}', round(sim, 3)) END AS value
FROM p, (VALUES (0), (1), (2)) z(k) WHERE x > 0 AND y > 0 AND greatest(x / y, y / x) <= 2.0""",
)
def pair_file(spark: SparkSession, sf: str) -> DataFrame:
    """F-11, J-13, K-09, M-01, M-08: pairs of like length in words, with the share of words they have in common, as lines of a pair file."""
    words = lambda c: F.split(T.squeeze(F.col(c)), " ")
    heard = read_table(spark, sf, "whisper_segments").select("recording_id", F.col("seg_file_no").alias("seg_no"), "pos", F.col("text").alias("source"), words("text").alias("a"))
    made = manual(spark, sf).select("recording_id", "seg_no", "pos", F.col("text").alias("target"), words("text").alias("b"))
    size = lambda c: F.size(F.filter(c, lambda x: x != ""))
    pairs = heard.join(made, ["recording_id", "seg_no", "pos"]).where(S.length_ratio_ok(size("a"), size("b"))).select("recording_id", "seg_no", F.col("pos").alias("pair_no"), "source", "target", F.round(S.dice(F.col("a"), F.col("b")), 3).alias("sim"))
    return sinks.pair_lines(pairs, ["recording_id", "seg_no"])


_BREAKS = r"\s*\n\s*"
_TOLD = "CASE WHEN contains(c, ',') THEN regexp_replace(c, '^[^,]*,', '') ELSE c END"


@query(
    "transcript_records",
    rf"""WITH t AS (SELECT recording_id, transcript_id, {strip_sql(gsub('transcript', _BREAKS, ' '))} AS said FROM transcripts WHERE transcript IS NOT NULL AND {strip_sql('transcript')} <> ''),
k AS (SELECT t.*, coalesce(speaker_codes, '') AS c FROM t JOIN audio_catalog USING (recording_id))
SELECT recording_id, CAST(row_number() OVER (PARTITION BY recording_id ORDER BY transcript_id) AS INT) AS id, said AS transcript, CAST(len(string_split(c, ',')) + len(string_split({_TOLD}, ',')) AS INT) AS max_speakers, CAST(len(string_split({_TOLD}, ',')) AS INT) AS min_speakers FROM k""",
)
def records(spark: SparkSession, sf: str) -> DataFrame:
    """S-08, T-04, A-13, F-18, K-03: the records of a file for each recording, made of its transcripts between a head of three
    lines, the last of them all speakers, and a last line of those but the first."""
    catalog = read_table(spark, sf, "audio_catalog").select("recording_id", F.coalesce("speaker_codes", F.lit("")).alias("c"))
    one = T.strip(F.regexp_replace("transcript", r"\s*\n\s*", "\n"))
    files = read_table(spark, sf, "transcripts").where(T.is_named(F.col("transcript"))).join(catalog, "recording_id")
    told = F.when(F.col("c").contains(","), F.regexp_replace("c", "^[^,]*,", "")).otherwise(F.col("c"))
    record = F.concat_ws("\n", F.lit("name"), F.lit("place"), "c", one, told)
    ordered = F.array_sort(F.collect_list(F.struct("transcript_id", record.alias("r"))))
    made = files.groupBy("recording_id").agg(F.array_join(F.transform(ordered, lambda x: x["r"]), "\n\n").alias("file"))
    return transcript_records(made, "recording_id", "file")


@query("parent_clips", f"SELECT i.recording_id, i.seg_no, p.name AS parent_name FROM {INDEX_SQL} i JOIN {INDEX_SQL} p ON p.recording_id = i.recording_id AND p.seg_no = i.prev")
def parent_clips(spark: SparkSession, sf: str) -> DataFrame:
    """J-15: the clip each continuation is to be joined to; those whose parent isn't there are skipped."""
    rows = index(spark, sf)
    return segments.parent_names(rows, "recording_id", "seg_no", "prev", "name")


@query("named_transcripts", f"SELECT recording_id, seg_no, transcript_id, left(transcript, 60) AS shown FROM transcripts JOIN {INDEX_SQL} i USING (recording_id, seg_no) WHERE i.trans AND {strip_sql('transcript')} <> '' AND {strip_sql('i.name')} <> ''")
def named_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """F-04 (NULL is false, as in 6b), F-06, T-19: transcripts of clips to be taken, that have a name and a text, as messages show them."""
    rows = index(spark, sf).where("trans").where(T.is_named(F.col("name"))).select("recording_id", "seg_no")
    texts = read_table(spark, sf, "transcripts").where(T.is_named(F.col("transcript")))
    return texts.join(rows, ["recording_id", "seg_no"]).select("recording_id", "seg_no", "transcript_id", T.shown(F.col("transcript")).alias("shown"))


@query(
    "audio_list",
    """WITH m AS (SELECT 0 AS part, row_number() OVER (ORDER BY recording_id) AS pos, original_name || original_extension AS path FROM audio_catalog WHERE duration_sec IS NOT NULL),
f AS (SELECT 1, 0, original_name || original_extension FROM audio_catalog WHERE lower(original_extension) IN ('.wav', '.mp3', '.flac', '.m4a', '.ogg', '.opus', '.webm')),
u AS (SELECT * FROM m UNION ALL SELECT * FROM f), g AS (SELECT path, min(ROW(part, pos, path)) AS spot FROM u GROUP BY path)
SELECT CAST(row_number() OVER (ORDER BY spot) - 1 AS INT) AS pos, path FROM g""",
)
def audio_list(spark: SparkSession, sf: str) -> DataFrame:
    """U-03, S-19, A-09: what a manifest names, then the audio files of a folder, each once."""
    rows = read_table(spark, sf, "audio_catalog")
    path = F.concat("original_name", "original_extension").alias("path")
    named = rows.where("duration_sec IS NOT NULL").select(F.lit(0).alias("part"), F.row_number().over(Window.orderBy("recording_id")).alias("pos"), path)
    found = rows.where(manifest.suffix(F.concat("original_name", "original_extension")).isin(*manifest.SUFFIXES)).select(F.lit(1).alias("part"), F.lit(0).alias("pos"), path)
    return manifest.united([named, found])


def _clip_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The transcript of each clip: its hand-made lines, one after another."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return manual(spark, sf).where("text IS NOT NULL").groupBy("recording_id", "seg_no").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("transcript"))


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    blocks = srt(spark, sf).where("start_code IS NOT NULL AND end_code IS NOT NULL").withColumn("speaker_tag", F.coalesce("speaker_tag", F.lit(""))).withColumn("text", F.coalesce("text", F.lit(""))).withColumnRenamed("seg_file_no", "seg_no")
    return products.merged_spans(blocks, _clip_texts(spark, sf), ["recording_id", "seg_no"])


@query("merged_spans")
def merged_spans(spark: SparkSession, sf: str) -> DataFrame:
    """J-10, stage 6c: every block with the stretch of the transcript it took, or its own text."""
    return _merged(spark, sf)


@query("merged_srt")
def merged_srt(spark: SparkSession, sf: str) -> DataFrame:
    """K-08: the same as the subtitle text of each clip."""
    return products.merged_srt(_merged(spark, sf), ["recording_id", "seg_no"])


def _clip_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The prepared segments (T-10) of each clip, numbered from 0."""
    parts = manual(spark, sf).select("recording_id", "seg_no", "pos", F.posexplode(T.prepared_segments(F.col("text"))).alias("part", "x"))
    place = F.row_number().over(Window.partitionBy("recording_id", "seg_no").orderBy("pos", "part")) - 1
    return parts.select("recording_id", "seg_no", place.alias("pos"), "x.orig", "x.norm")


@query("composed_blocks")
def composed_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """T-12, J-09, W-05, stage 6b: every block with the text and the speaker of the hand-made lines it took."""
    keys = ["recording_id", "seg_no"]
    blocks = srt(spark, sf).select("recording_id", F.col("seg_file_no").alias("seg_no"), "srt_index", F.nullif(F.regexp_extract("speaker_tag", r"\[(SPEAKER_[0-9]+)\]:", 1), F.lit("")).alias("speaker"), F.array(F.trim(F.concat_ws(" ", "speaker_tag", "text"))).alias("orig_lines"), T.norm_match(F.coalesce("text", F.lit("")), srt=True).alias("l_norm"))
    lines = stage(_clip_lines(spark, sf))
    matches = matching.aligned(blocks.withColumnRenamed("srt_index", "l_pos").select(*keys, "l_pos", "l_norm"), lines.select(*keys, F.col("pos").alias("r_pos"), F.col("norm").alias("r_norm")), keys, matching.greedy_pointer)
    return products.composed(blocks, lines, stage(matches.select(*keys, F.col("l_pos").alias("srt_index"), F.col("r_pos").alias("pos"))), keys)


@query("final_runs")
def final_runs(spark: SparkSession, sf: str) -> DataFrame:
    """T-15, J-08, N-2, A-14, stage 6a: every recognised sentence reached, as its header and the transcript's sentences."""
    keys = ["recording_id", "seg_no"]
    block = block_text(F.col("srt_index"), F.col("start_code"), F.col("end_code"), F.trim("speaker_tag"), F.col("text"))
    heard = srt(spark, sf).where("start_code IS NOT NULL AND end_code IS NOT NULL").select("recording_id", F.col("seg_file_no").alias("seg_no"), "srt_index", block.alias("orig"))
    sources = segments.ordered_distinct(heard.withColumn("l_norm", T.norm_header(F.col("orig"))), keys, "l_norm", "orig", "srt_index").withColumnRenamed("srt_index", "l_pos")
    parts = _clip_texts(spark, sf).select(*keys, F.posexplode(T.split_sentences(F.col("transcript"))).alias("r_pos", "orig"))
    targets = segments.ordered_distinct(parts.withColumn("r_norm", T.norm_marks(F.col("orig"))), keys, "r_norm", "orig", "r_pos")
    targets, sources = stage(targets), stage(sources)
    matches = matching.aligned(sources.select(*keys, "l_pos", "l_norm"), targets.select(*keys, "r_pos", "r_norm"), keys, matching.greedy_run)
    return products.final_runs(sources, targets, matches, keys)


def _dialect(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    heard = srt(spark, sf).select("recording_id", F.col("seg_file_no").alias("seg_no"), F.col("srt_index").alias("pos"), "text").where("text IS NOT NULL")
    return products.dialect_texts(heard, manual(spark, sf).select("recording_id", "seg_no", "pos", "text"), ["recording_id", "seg_no"], 0.6)


@query(
    "dialect_counts",
    rf"""WITH h AS (SELECT recording_id, seg_file_no AS seg_no, srt_index AS pos, text FROM {SRT_SQL} WHERE text IS NOT NULL),
p AS (SELECT recording_id, seg_no, pos, string_split(regexp_replace(text, '(\[[^\n]*?\])', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS ps FROM {MANUAL_SQL}),
u AS (SELECT recording_id, seg_no, pos, {strip_sql('unnest(ps)')} AS x, generate_subscripts(ps, 1) AS k FROM p),
c AS (SELECT *, regexp_full_match(x, '(?s)\[.*\]') AS inside FROM u WHERE x <> ''),
d AS (SELECT *, CASE WHEN inside THEN {strip_sql('substr(x, 2, length(x) - 2)')} ELSE x END AS said FROM c),
e AS (SELECT * FROM d WHERE NOT (inside AND (said = '' OR starts_with(said, '…') OR starts_with(said, 'Соб.')))),
s AS (SELECT recording_id, seg_no, pos, k, {_bytes_sql(_norm_edit_sql('said'))} AS l FROM e WHERE inside), r AS (SELECT recording_id, seg_no, pos AS r_pos, {_bytes_sql(_norm_edit_sql('text'))} AS r FROM h),
q AS (SELECT recording_id, seg_no, pos, k, r_pos, 1 - levenshtein(l, r) / greatest(length(l), length(r)) AS sim FROM s JOIN r USING (recording_id, seg_no) WHERE l <> '' AND r <> ''),
b AS (SELECT recording_id, seg_no, first(r_pos ORDER BY sim DESC, r_pos) AS r_pos FROM q WHERE sim >= 0.6 GROUP BY recording_id, seg_no, pos, k),
w AS (SELECT recording_id, seg_no, count(DISTINCT r_pos) AS n FROM b GROUP BY ALL),
t AS (SELECT recording_id, seg_no, count(*) AS whisper_total FROM h GROUP BY ALL), m AS (SELECT recording_id, seg_no, count(*) AS manual_total, count_if(NOT inside) AS manual_dialect FROM e GROUP BY ALL)
SELECT recording_id, seg_no, whisper_total, whisper_total - coalesce(n, 0) AS whisper_dialect, coalesce(n, 0) AS whisper_standard, manual_total, manual_dialect, manual_total - manual_dialect AS manual_standard FROM t JOIN m USING (recording_id, seg_no) LEFT JOIN w USING (recording_id, seg_no)""",
)
def dialect_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A-03, F-14, J-06, stage 6e: how much of both sides of a clip is in dialect."""
    return _dialect(spark, sf)[1]


@query("dialect_pairs")
def dialect_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """J-11, J-12, M-06, M-07, F-11, stage 6e: pairs of dialect segments in their original spelling."""
    return products.dialect_pairs(_dialect(spark, sf)[0], ["recording_id", "seg_no"], 0.6).where("kept").drop("kept").withColumn("sim", F.round("sim", 6))


@query("chain_summary")
def chain_summary(spark: SparkSession, sf: str) -> DataFrame:
    """K-11, A-03 to A-06: a row for each clip with what came of it, or with the reason why nothing did."""
    keys = ["recording_id", "seg_no"]
    texts, counts = _dialect(spark, sf)
    counts = stage(counts)
    summary = products.chain_summary(counts, stage(products.dialect_pairs(texts, keys, 0.6)), keys)
    clips = index(spark, sf).select(*keys)
    heard = read_table(spark, sf, "srt_segments").where("text IS NOT NULL").select("recording_id", F.col("seg_file_no").alias("seg_no")).distinct().withColumn("has_srt", F.lit(True))
    made = read_table(spark, sf, "manual_segments").select(*keys).distinct().withColumn("has_text", F.lit(True))
    known = clips.join(heard, keys, "left").join(made, keys, "left").na.fill(False, ["has_srt", "has_text"])
    return products.with_errors(summary.withColumn("mean_similarity", F.round("mean_similarity", 6)), known, keys)


@query(
    "utterance_files",
    rf"""WITH b AS (SELECT recording_id, seg_file_no, srt_index, format('{{:03d}}_', srt_index) || coalesce(nullif(regexp_extract(speaker_tag, '^\[(SPEAKER_[0-9]+)\]:$', 1), ''), 'UNKNOWN') || '_' || translate(replace(start_code, ',', '.'), ':.', '--') AS base, coalesce(text, '') AS text
FROM {SRT_SQL} WHERE start_code IS NOT NULL)
SELECT recording_id, seg_file_no, base || CASE k WHEN 0 THEN '_orig.txt' ELSE '.txt' END AS file, CASE k WHEN 0 THEN text ELSE {_clean_sql(gsub('text', _BRACKETS, ' '))} END AS content FROM b, (VALUES (0), (1)) z(k)""",
)
def utterance_files(spark: SparkSession, sf: str) -> DataFrame:
    """K-13, T-16, T-17: the two text files that stand beside each utterance's clip."""
    tag = F.regexp_extract("speaker_tag", r"^\[(SPEAKER_[0-9]+)\]:$", 1)
    rows = srt(spark, sf).where("start_code IS NOT NULL").withColumn("speaker", F.coalesce(F.when(tag != "", tag), F.lit("UNKNOWN"))).withColumn("start_code", F.replace("start_code", F.lit(","), F.lit(".")))
    return sinks.utterance_texts(rows.withColumn("text", F.coalesce("text", F.lit(""))), CLIP)
