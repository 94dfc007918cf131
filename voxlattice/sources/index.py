"""Recording indexes and transcript files: plain text, DOCX, CSV and TSV."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlattice.functions import text as T

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def text_lines(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """S-04: recording_id, line_no, line of every text file, in the order of the file."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return raw.select(name.alias("recording_id"), F.posexplode(F.split(F.regexp_replace("value", r"﻿", ""), r"\R")).alias("line_no", "line"))


def docx_paragraphs(blob: bytes) -> list[str]:
    """S-05 to S-07: the text of each paragraph of a document; raises on a broken archive."""
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return ["".join(t.text or "" for t in p.iter(f"{_W}t")) for p in root.iter(f"{_W}p")]


def docx_lines(spark: SparkSession, path: str) -> DataFrame:
    """S-05 to S-07: recording_id, line_no, line, _error of every DOCX below path; a broken file is one row with its error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p, blob in zip(frame["path"], frame["content"]):
                name = p.rpartition("/")[2].rpartition(".")[0]
                try:
                    rows += [(name, i, line, None) for i, line in enumerate(docx_paragraphs(blob))]
                except zipfile.BadZipFile:
                    rows.append((name, None, None, "not an archive"))
                except KeyError:
                    rows.append((name, None, None, "no document in the archive"))
                except ElementTree.ParseError:
                    rows.append((name, None, None, "broken document"))
            yield pd.DataFrame(rows, columns=["recording_id", "line_no", "line", "_error"]).astype({"line_no": "Int32"})

    return files.mapInPandas(run, "recording_id string, line_no int, line string, _error string")


def parse_index(lines: DataFrame, suffix: str = ".wav") -> DataFrame:
    """T-03, W-01: the coded lines of each recording as numbered segments; lines without a code at their head go.

    seg_no counts from 0 in the order of the file. A recording's index is one file of some hundred lines.
    """
    coded = lines.where(T.starts_with_code(F.col("line")))
    number = F.row_number().over(Window.partitionBy("recording_id").orderBy("line_no")) - 1
    parsed = coded.select("recording_id", number.alias("seg_no"), T.time_code(F.col("line")).alias("start"), T.is_transcribed(F.col("line")).alias("trans"), T.continuation_code(F.col("line")).alias("cont"), T.strip(F.col("line")).alias("text"))
    return parsed.withColumn("name", F.concat("recording_id", F.lit("No"), "seg_no", F.lit(suffix)))


def transcript_records(df: DataFrame, key: str, value: str) -> DataFrame:
    """S-08, T-04, A-13, F-18: records split at blank lines: line 3 the interviewers, the last line the interviewees,
    the lines between the transcript, joined by blanks. max_speakers counts the names of both lines, min_speakers those of the last."""
    records = df.select(key, F.posexplode(F.split(F.regexp_replace(value, r"\n+$", ""), "\n\n")).alias("_no", "_record"))
    lines = F.split("_record", "\n")
    count = lambda x: F.size(F.split(F.coalesce(x, F.lit("")), ","))
    asked, told = count(F.try_element_at(lines, F.lit(3))), count(F.element_at(lines, -1))
    said = F.array_join(F.slice(lines, 4, F.greatest(F.size(lines) - 4, F.lit(0))), " ")
    return records.select(key, (F.col("_no") + 1).alias("id"), said.alias("transcript"), (asked + told).alias("max_speakers"), told.alias("min_speakers"))


def read_table_file(spark: SparkSession, path: str, schema: str, sep: str = ",", drop_first: bool = False, bad: str = "_corrupt") -> DataFrame:
    """S-09 to S-11: CSV or TSV with quoted line breaks; what doesn't fit the schema stands in the column `bad`."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).schema(f"{schema}, {bad} string").csv(path)
    return df.drop(df.columns[0]) if drop_first else df


def read_folder(spark: SparkSession, folder: str, schema: str, glob: str = "*.csv") -> DataFrame:
    """S-16: the rows of all CSV files of a folder, with `file`, the name of theirs without its suffix."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("pathGlobFilter", glob).schema(schema).csv(folder)
    return df.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("file"))
