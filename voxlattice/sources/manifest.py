"""Lists of audio files: manifests of paths or JSON lines, folders, and catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Suffixes of audio files.
SUFFIXES = (".wav", ".mp3", ".flac", ".m4a", ".ogg", ".opus", ".webm")


def manifest_path(line: Column) -> Column:
    """S-18, JS-01: the path a line names, plain or as the field path of a JSON object; NULL for blank lines and others."""
    s = F.trim(line)
    path = F.when(s.startswith("{"), F.get_json_object(s, "$.path")).otherwise(s)
    return F.when(path != "", path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """pos, path of a manifest in its order, each path at its first place only (A-09)."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split("value", r"\R")).alias("pos", "line")).select("pos", manifest_path(F.col("line")).alias("path"))
    return lines.where("path IS NOT NULL").groupBy("path").agg(F.min("pos").alias("pos")).select("pos", "path")


def suffix(name: Column) -> Column:
    """The last suffix in lower case with its dot, or ''."""
    return F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))


def find_audio(spark: SparkSession, folder: str, glob: str = "*", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """S-01 to S-03, S-19: path, name, ext, length of all files of these suffixes (any case) below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path", "length", "modificationTime")
    file = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.select("path", F.regexp_replace(file, r"\.[^.]*$", "").alias("name"), suffix(file).alias("ext"), "length").where(F.col("ext").isin(*suffixes))


def discovered(spark: SparkSession, manifest: str | None = None, folder: str | None = None, glob: str = "*") -> DataFrame:
    """U-03: pos, path of what the manifest names, in its order, then of the files of the folder by path; each path at its
    first place. With neither it is empty."""
    parts = []
    if manifest:
        parts.append(read_manifest(spark, manifest).select(F.lit(0).alias("part"), "pos", "path"))
    if folder:
        parts.append(find_audio(spark, folder, glob).select(F.lit(1).alias("part"), F.lit(0).alias("pos"), F.regexp_replace("path", "^file:/*", "/").alias("path")))
    return united(parts) if parts else spark.createDataFrame([], "pos int, path string")


def united(parts: list[DataFrame]) -> DataFrame:
    """pos, path of rows (part, pos, path) by part, pos and path, each path at its first place."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    first = whole.where("path IS NOT NULL").groupBy("path").agg(F.min(F.struct("part", "pos", "path")).alias("at"))
    # A list of files, as one recogniser takes it, is numbered in one task.
    return first.select((F.row_number().over(Window.orderBy("at")) - 1).alias("pos"), "path")


def limited(items: DataFrame, n: int) -> DataFrame:
    """O-05: the first n in the order of discovery."""
    return items.orderBy("pos").limit(n)
