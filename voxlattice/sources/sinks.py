"""Writers: CSV, TSV, JSON lines, SRT and text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlattice.functions import text as T
from voxlattice.sources.srt import render_srt


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """K-01 to K-05: with a header, NULL as empty, quotes doubled."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').option("emptyValue", "").csv(path)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """K-05: the bytes of a file under another name, whose folder is made if need be."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)


def write_results(df: DataFrame, path: str) -> None:
    """K-12, JS-02: JSON lines (NULL fields kept) or CSV by the path's suffix; another suffix is an error."""
    if path.endswith(".jsonl"):
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif path.endswith(".csv"):
        write_csv(df, path)
    else:
        raise ValueError(f"no way to write {path}: .jsonl or .csv")


def write_srt(df: DataFrame, keys: list[str], path: str, order: str = "srt_index") -> None:
    """K-07: a text file of blocks per clip, in a folder named after its keys."""
    render_srt(df, keys, order).select(*keys, F.concat("srt", F.lit("\n")).alias("value")).write.mode("overwrite").partitionBy(*keys).text(path)


def utterance_texts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """K-13: keys, file, content: for each utterance its text as it is and its clean form, in files named like its clip."""
    base = T.utterance_name(F.col("srt_index"), F.col("speaker"), F.col("start_code"))
    files = F.array(F.struct(F.concat(base, F.lit("_orig.txt")).alias("file"), F.col("text").alias("content")), F.struct(F.concat(base, F.lit(".txt")).alias("file"), T.clean_without_notes(F.col("text")).alias("content")))
    return rows.select(*keys, F.explode(files).alias("x")).select(*keys, "x.file", "x.content")


def write_texts(df: DataFrame, keys: list[str], text: str, path: str) -> None:
    """K-10: a text file for each row, in a folder named after its keys."""
    df.select(*keys, F.col(text).alias("value")).write.mode("overwrite").partitionBy(*keys).option("lineSep", "\n").text(path)


def pair_lines(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """K-09: keys, line_no, value: for pair i the lines 'i> source', 'i= target', 'i# score'."""
    n = F.col("pair_no").cast("string")
    lines = F.array(F.concat(n, F.lit("> "), "source"), F.concat(n, F.lit("= "), "target"), F.concat(n, F.lit("# "), F.format_string("%.3f", "sim")))
    return pairs.select(*keys, "pair_no", F.posexplode(lines).alias("_at", "value")).select(*keys, (F.col("pair_no") * 3 + F.col("_at")).alias("line_no"), "value")


def run_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A-03: per clip the counts of both sides. products.chain_summary() has the rest of K-11."""
    side = lambda s, d: F.count_if((F.col("side") == s) & F.col("is_dialect").eqNullSafe(d))
    counts = [side(s, d).alias(f"{s}_{'dialect' if d else 'standard'}") for s in ("whisper", "manual") for d in (True, False)]
    return rows.groupBy(*keys).agg(F.count_if(F.col("side") == "whisper").alias("whisper_total"), F.count_if(F.col("side") == "manual").alias("manual_total"), *counts)
