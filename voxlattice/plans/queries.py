"""Queries over the test tables, by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlattice.operators import bad_rows, hierarchy, intervals
from voxlattice.runtime import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


def ms_sql(column: str) -> str:
    """DuckDB expression for code_ms()."""
    s = rf"regexp_replace({column}, '[\s\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200B}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{FEFF}}]+', '', 'g')"
    part = lambda i: rf"CAST(regexp_extract({s}, '^(\d+):(\d+):(\d+)[.,](\d+)$', {i}) AS BIGINT)"
    return f"CASE WHEN regexp_full_match({s}, '[0-9]{{1,6}}:[0-5]?[0-9]:[0-5]?[0-9][.,][0-9]{{3}}') THEN {part(1)}*3600000+{part(2)}*60000+{part(3)}*1000+{part(4)} END"


def latest_sql(table: str, keys: str) -> str:
    """Rows of the table without earlier versions."""
    return f"(SELECT DISTINCT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY loaded_at DESC NULLS LAST) = 1)"


_BLOCKS_SQL = f"""
b AS (
  SELECT recording_id, seg_file_no, try_cast(regexp_extract(speaker_tag, '([0-9]+)', 1) AS INT) AS speaker_no,
         {ms_sql('start_code')} AS s, {ms_sql('end_code')} AS e
  FROM {latest_sql('srt_segments', 'recording_id, seg_file_no, srt_index')}),
c AS (SELECT * FROM b WHERE speaker_no IS NOT NULL AND e > s),
m AS (SELECT *, max(e) OVER (PARTITION BY recording_id, seg_file_no, speaker_no ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c)
"""


@query(
    "p1_found",
    f"""WITH {_BLOCKS_SQL}
SELECT recording_id, seg_file_no, speaker_no, reach AS gap_start_ms, s AS gap_end_ms FROM m WHERE s > reach""",
)
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps in each speaker's speech within a clip."""
    blocks = intervals.timed_blocks(read_table(spark, sf, "srt_segments"))
    found = intervals.gaps(blocks, ["recording_id", "seg_file_no", "speaker_no"])
    return found.select("recording_id", "seg_file_no", "speaker_no", F.col("gap_start").alias("gap_start_ms"), F.col("gap_end").alias("gap_end_ms"))


@query(
    "p1_periods",
    f"""WITH {_BLOCKS_SQL},
r AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, seg_file_no, speaker_no ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM m)
SELECT recording_id, seg_file_no, speaker_no, min(s) AS period_start_ms, max(e) AS period_end_ms
FROM r GROUP BY recording_id, seg_file_no, speaker_no, n""",
)
def p1_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous stretches of each speaker's speech within a clip."""
    blocks = intervals.timed_blocks(read_table(spark, sf, "srt_segments"))
    found = intervals.periods(blocks, ["recording_id", "seg_file_no", "speaker_no"])
    return found.select("recording_id", "seg_file_no", "speaker_no", F.col("period_start").alias("period_start_ms"), F.col("period_end").alias("period_end_ms"))


_LINKS_SQL = f"""
n AS (SELECT recording_id, seg_no, prev, name, {ms_sql('start_code')} AS start_ms, {ms_sql('cont')} AS cont_ms
      FROM {latest_sql('index_segments', 'recording_id, seg_no')} WHERE recording_id IS NOT NULL AND seg_no IS NOT NULL),
t AS (SELECT recording_id, cont_ms, max(seg_no) AS from_no FROM n WHERE cont_ms IS NOT NULL GROUP BY ALL),
l AS (SELECT n.recording_id, n.seg_no, n.name, coalesce(n.prev, t.from_no) AS p
      FROM n LEFT JOIN t ON n.recording_id = t.recording_id AND n.start_ms = t.cont_ms),
k AS (SELECT l.recording_id, l.seg_no, l.name, x.seg_no AS p FROM l LEFT JOIN l x ON l.recording_id = x.recording_id AND l.p = x.seg_no),
w AS (SELECT recording_id, seg_no, seg_no AS root_no, 0 AS depth FROM k WHERE p IS NULL
      UNION ALL SELECT k.recording_id, k.seg_no, w.root_no, w.depth + 1 FROM k JOIN w ON k.recording_id = w.recording_id AND k.p = w.seg_no)
"""


def _segment_tree(spark: SparkSession, sf: str, paths: bool = False) -> tuple[DataFrame, DataFrame]:
    links = hierarchy.continuation_links(read_table(spark, sf, "index_segments"))
    return hierarchy.hierarchy(links, "recording_id", "seg_no", "parent_no", paths), links


@query(
    "p2_found",
    f"""WITH RECURSIVE {_LINKS_SQL}
SELECT k.recording_id, k.seg_no, coalesce(w.root_no, -1) AS root_no
FROM k LEFT JOIN w ON k.recording_id = w.recording_id AND k.seg_no = w.seg_no WHERE k.p IS NOT NULL""",
)
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Root of each segment that continues another; -1 where the way up never ends."""
    tree, _ = _segment_tree(spark, sf)
    return tree.where("parent_no IS NOT NULL").select("recording_id", "seg_no", F.coalesce("root", F.lit(-1)).alias("root_no"))


@query(
    "p2_paths",
    f"""WITH RECURSIVE {_LINKS_SQL},
d AS (SELECT recording_id, seg_no, seg_no AS below FROM k
      UNION SELECT d.recording_id, d.seg_no, k.seg_no FROM d JOIN k ON k.recording_id = d.recording_id AND k.p = d.below),
o AS (SELECT DISTINCT d.recording_id, d.seg_no FROM d JOIN k ON k.recording_id = d.recording_id AND k.seg_no = d.seg_no AND k.p = d.below),
s AS (SELECT recording_id, seg_no, count(DISTINCT below) AS size FROM d GROUP BY ALL),
u AS (SELECT recording_id, seg_no, CAST(seg_no AS VARCHAR) AS path, coalesce(name, '') AS path_names FROM k WHERE p IS NULL
      UNION ALL SELECT k.recording_id, k.seg_no, u.path || '/' || k.seg_no, u.path_names || '/' || coalesce(k.name, '')
      FROM k JOIN u ON k.recording_id = u.recording_id AND k.p = u.seg_no)
SELECT k.recording_id, k.seg_no, k.p AS parent_no, w.root_no, w.depth, u.path, u.path_names, s.size, w.root_no IS NULL AS on_cycle, o.seg_no IS NOT NULL AS in_circle
FROM k LEFT JOIN o USING (recording_id, seg_no) LEFT JOIN w USING (recording_id, seg_no) LEFT JOIN s USING (recording_id, seg_no) LEFT JOIN u USING (recording_id, seg_no)""",
)
def p2_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Parent, root, depth, path of numbers and of clip names, and subtree size of every segment.

    on_cycle is true on a circle and below one, in_circle on it only; what is on a circle has all that is on it in its size.
    """
    tree, links = _segment_tree(spark, sf, paths=True)
    named = hierarchy.named_paths(hierarchy.whole_sizes(tree, "recording_id"), links, "recording_id", "seg_no", "name")
    spelt = F.array_join(F.transform("path_names", lambda x: F.coalesce(x, F.lit(""))), "/")
    return named.select("recording_id", "seg_no", "parent_no", F.col("root").alias("root_no"), "depth", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"), spelt.alias("path_names"), "size", "on_cycle", F.col("circle").isNotNull().alias("in_circle"))


@query(
    "p2_descendants",
    f"""WITH RECURSIVE {_LINKS_SQL},
d AS (SELECT recording_id, p AS seg_no, seg_no AS descendant FROM k WHERE p IS NOT NULL
      UNION SELECT d.recording_id, k.p, d.descendant FROM d JOIN k ON k.recording_id = d.recording_id AND k.seg_no = d.seg_no WHERE k.p IS NOT NULL)
SELECT * FROM d WHERE seg_no <> descendant""",
)
def p2_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """All descendants of every segment, by preorder ranges. What is on a circle has all others on it, and what hangs on them."""
    tree, _ = _segment_tree(spark, sf)
    return hierarchy.descendants(tree, "recording_id", "seg_no", circles=True)


def _fields_sql(d: str) -> str:
    """Five fields of a line, quoted or bare, as groups."""
    return d.join([rf'("(?:[^"]|"")*"|[^"{d}]*)'] * 5)


def _sound_sql(d: str) -> str:
    field = rf'(?:"(?:[^"]|"")*"|[^"{d}]*)'
    return f"{field}(?:{d}{field})*"


def _rows_sql(rest: str) -> str:
    """Lines with their reason and unquoted fields, then what is to be told of them."""
    field = lambda i: rf"""CASE WHEN starts_with(regexp_extract(s, p, {i}), '"') THEN replace(substr(regexp_extract(s, p, {i}), 2, length(regexp_extract(s, p, {i})) - 2), '""', '"') ELSE regexp_extract(s, p, {i}) END AS f{i}"""
    clock = "[0-9]{2}:[0-5][0-9]:[0-5][0-9][.,][0-9]{3}"
    return rf"""WITH l AS (SELECT line_id, lower(coalesce(file_format, '')) = 'tsv' AS tsv, regexp_replace(raw_line, '\r$', '') AS s FROM raw_segment_rows),
k AS (SELECT line_id, s, CASE WHEN tsv THEN '(?s)^{_fields_sql(chr(9))}$' ELSE '(?s)^{_fields_sql(",")}$' END AS p,
  CASE WHEN tsv THEN regexp_full_match(s, '(?s){_sound_sql(chr(9))}') ELSE regexp_full_match(s, '(?s){_sound_sql(",")}') END AS sound FROM l),
f AS (SELECT line_id, sound, s IS NOT NULL AND regexp_matches(s, p) AS five, {", ".join(map(field, range(1, 6)))} FROM k),
r AS (SELECT *, CASE WHEN NOT sound THEN 'quoting' WHEN NOT five THEN 'columns'
  WHEN NOT regexp_full_match(f1, '[ \t\x{{00A0}}]*[0-9]+[ \t\x{{00A0}}]*') OR CAST(regexp_extract(f1, '[0-9]+', 0) AS HUGEINT) > 2147483647 THEN 'index'
  WHEN NOT regexp_full_match(f2, '{clock}') THEN 'start' WHEN NOT regexp_full_match(f3, '{clock}') THEN 'end'
  WHEN {ms_sql('f3')} <= {ms_sql('f2')} THEN 'order' WHEN NOT regexp_matches(f5, '[^\p{{Z}}\p{{C}}\x{{034F}}\x{{115F}}\x{{1160}}\x{{2800}}\x{{3164}}\x{{FFA0}}\x{{FE00}}-\x{{FE0F}}]') THEN 'text' END AS reason FROM f)
{rest}"""


@query("p4_found", _rows_sql("SELECT line_id, reason FROM r WHERE reason IS NOT NULL"))
def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that can't be loaded, with the reason."""
    return bad_rows.split_rows(read_table(spark, sf, "raw_segment_rows"))[1].select("line_id", "reason")


@query(
    "p4_loaded",
    _rows_sql(f"SELECT line_id, CAST(regexp_extract(f1, '[0-9]+', 0) AS INT) AS srt_index, {ms_sql('f2')} AS start_ms, {ms_sql('f3')} AS end_ms, nullif(f4, '') AS speaker, f5 AS seg_text FROM r WHERE reason IS NULL"),
)
def p4_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that load, with typed fields."""
    return bad_rows.split_rows(read_table(spark, sf, "raw_segment_rows"))[0]


_EDITS_SQL = r"""WITH RECURSIVE l AS (SELECT line_id, CASE WHEN lower(coalesce(file_format, '')) = 'tsv' THEN chr(9) ELSE ',' END AS d, regexp_replace(raw_line, '\r$', '') AS s FROM raw_segment_rows),
w AS (SELECT line_id, d, s, 0 AS i, 0 AS h, 1000000 AS b, 1000000 AS q, 1000000 AS c, 0 AS n FROM l WHERE s IS NOT NULL
  UNION ALL SELECT line_id, d, s, i + 1,
    CASE x WHEN '"' THEN h + 1 WHEN d THEN least(h, b, c, q + 1) ELSE 1000000 END,
    CASE x WHEN '"' THEN b + 1 WHEN d THEN 1000000 ELSE least(h, b) END,
    CASE x WHEN '"' THEN least(h, c, q + 1) WHEN d THEN least(q, h + 1) ELSE least(q, h + 1, c + 1) END,
    CASE x WHEN '"' THEN least(q, c + 1) ELSE 1000000 END,
    n + CASE WHEN x = d AND (h = 0 OR b = 0 OR c = 0) THEN 1 ELSE 0 END
  FROM (SELECT *, substr(s, i + 1, 1) AS x FROM w WHERE i < length(s))),
e AS (SELECT line_id, least(h, b, c, q + 1) AS quote_edits, n FROM w WHERE i = length(s) UNION ALL SELECT line_id, 0, 0 FROM l WHERE s IS NULL)
SELECT line_id, quote_edits, CASE WHEN quote_edits = 0 THEN abs(n - 4) END AS delimiter_edits FROM e WHERE quote_edits > 0 OR n <> 4"""


@query("p4_edits", _EDITS_SQL)
def p4_edits(spark: SparkSession, sf: str) -> DataFrame:
    """How many quotes, and in lines of sound quoting how many delimiters, must be inserted or deleted for a line to parse."""
    bad = bad_rows.split_rows(read_table(spark, sf, "raw_segment_rows"))[1].where("quote_edits + delimiter_edits > 0")
    return bad.select("line_id", "quote_edits", F.when(F.col("quote_edits") == 0, F.col("delimiter_edits")).alias("delimiter_edits"))
