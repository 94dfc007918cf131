"""Subtitle files that arrive one by one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxlattice.sources.srt import MERGE, Rules, parse_blocks


def stream_blocks(spark: SparkSession, folder: str, rules: Rules = MERGE) -> DataFrame:
    """Blocks of every SRT file that appears in a folder, with recording_id and seg_no from its name."""
    raw = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.srt").load(folder)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.srt$", 1)
    named = raw.select(F.regexp_extract(name, r"^(.*)No([0-9]+)$", 1).alias("recording_id"), F.regexp_extract(name, r"^(.*)No([0-9]+)$", 2).try_cast("int").alias("seg_no"), F.col("value").alias("srt"))
    return parse_blocks(named, "srt", rules)


def each_batch(blocks: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs the batch operators on each new set of files; ends when all that is there has been worked on."""
    return blocks.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(work).start()
