"""Problem 1: continuous periods and gaps of overlapping, nested and gapped intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlattice.functions.timecode import code_ms, speaker_number
from voxlattice.operators.latest import latest
from voxlattice.operators.ordered import blocked_scan

#: Boundaries of one entity that lie in one stretch of this length are ranked by one task.
BLOCK_LENGTH = 600_000


def _ranked(df: DataFrame, entity: list[str], start: str, end: str, block_length: int) -> DataFrame:
    """One row per entity and boundary value: rank of the last start and of the last end up to it, and the next start.

    Starts and ends are ranked independently of each other; equal boundaries are added up before the shuffle.
    """
    begin, stop = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    one = lambda at, s, e: F.struct(at.alias("_t"), F.lit(s).alias("_ns"), F.lit(e).alias("_ne"))
    edges = (
        df.where(stop > begin)
        .select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(entity)], F.explode(F.array(one(begin, 1, 0), one(stop, 0, 1))).alias("_x"))
        .select(*[f"_e{i}" for i in range(len(entity))], "_x.*")
    )
    names = [f"_e{i}" for i in range(len(entity))]
    counted = (
        edges.groupBy(*names, "_t")
        .agg(F.sum("_ns").alias("_ns"), F.sum("_ne").alias("_ne"))
        .select("*", F.floor(F.col("_t") / block_length).alias("_block"), F.when(F.col("_ns") > 0, F.col("_t")).alias("_start"), F.when(F.col("_ne") > 0, F.col("_t")).alias("_end"))
    )
    return blocked_scan(counted, names, "_block", "_t", sums={"_rank_s": "_ns", "_rank_e": "_ne"}, after={"_next": "_start"})


def gaps(df: DataFrame, entity: list[str], start: str = "start_ms", end: str = "end_ms", block_length: int = BLOCK_LENGTH) -> DataFrame:
    """Gaps between the intervals of each entity, as entity columns, gap_start, gap_end.

    With starts and ends sorted on their own, a gap follows the end of rank r if the start of rank r + 1 is
    greater: up to that end, as many starts as ends have passed. Touching intervals leave no gap. Rows whose
    start, end or entity is NULL, or whose end isn't after the start, don't count; repeated rows change nothing; an
    empty table gives an empty one; other columns are dropped.
    """
    ranked = _ranked(df, entity, start, end, block_length)
    return ranked.where((F.col("_rank_s") == F.col("_rank_e")) & F.col("_next").isNotNull()).select(
        *[F.col(f"_e{i}").alias(k) for i, k in enumerate(entity)], F.col("_t").alias("gap_start"), F.col("_next").alias("gap_end")
    )


def periods(df: DataFrame, entity: list[str], start: str = "start_ms", end: str = "end_ms", block_length: int = BLOCK_LENGTH) -> DataFrame:
    """Continuous periods of each entity, as entity columns, period_start, period_end; cases as in gaps().

    A period begins where no interval is open just before, and ends where as many ends as starts have passed;
    the boundaries of both kinds alternate, so each end is paired with the last beginning before it.
    """
    ranked = _ranked(df, entity, start, end, block_length)
    names = [f"_e{i}" for i in range(len(entity))]
    opens = F.col("_rank_s") - F.col("_ns") == F.col("_rank_e") - F.col("_ne")
    marked = ranked.select(*names, "_t", "_block", F.when(opens & (F.col("_ns") > 0), F.col("_t")).alias("_open"), (F.col("_rank_s") == F.col("_rank_e")).alias("_closes"))
    marked = marked.where(F.col("_open").isNotNull() | F.col("_closes"))
    paired = blocked_scan(marked, names, "_block", "_t", before={"_from": "_open"})
    return paired.where("_closes").select(*[F.col(f"_e{i}").alias(k) for i, k in enumerate(entity)], F.col("_from").alias("period_start"), F.col("_t").alias("period_end"))


def timed_blocks(srt: DataFrame) -> DataFrame:
    """The latest version of each block that counts: numbered speaker and readable times, end after start."""
    parsed = srt.select("recording_id", "seg_file_no", "srt_index", "loaded_at", code_ms(F.col("start_code")).alias("start_ms"), code_ms(F.col("end_code")).alias("end_ms"), speaker_number(F.col("speaker_tag")).alias("speaker_no"))
    kept = latest(parsed, ["recording_id", "seg_file_no", "srt_index"], ["start_ms", "end_ms", "speaker_no"])
    return kept.where(F.col("speaker_no").isNotNull() & (F.col("end_ms") > F.col("start_ms")))
