"""Problem 8: mixing sources to target weights along a curriculum.

Every source has a schedule of weights over the course of training, piecewise linear in t from 0 to 1. Its integral
is the source's cumulative demand for tokens; a document that begins after so many tokens of its source gets the
position t at which the demand reaches that number. Documents, repeated where a source is small, are then sorted by
position over ranges.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlattice.operators.ordered import blocked_scan
from voxlattice.runtime import stage

#: File of ranks of a public byte-level tokenizer; it must lie at this path on every executor.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern by which that tokenizer cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: About how many documents of a source one task adds up.
BLOCK = 4096
#: Sources a list of targets may have.
MOST_TARGETS = 10_000

Schedule = list[tuple[float, float]]


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, text: str = "text", to: str = "tokens", path: str = TOKENIZER) -> DataFrame:
    """docs without the text but with its length in tokens. NULL and empty texts have 0; texts are taken whole."""
    kept = [c for c in docs.columns if c not in (text, to)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path).encode_ordinary
        for batch in batches:
            size = [len(encode(t)) if t else 0 for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(size, pa.int64())], [*kept, to])

    return docs.select(*kept, text).mapInArrow(run, docs.select(*kept).schema.add(to, "long"))


def source_name(source: Column) -> Column:
    """The name of a source without differences of case, blanks and hyphens; NULL stays NULL."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s_-]+", "_")


def _pieces(knots: Schedule) -> list[tuple[float, float, float, float, float, float]]:
    """(share of demand before, share after, t before, weight before, slope, area): the schedule with integral 1."""
    knots = sorted((float(t), float(w)) for t, w in knots)
    if len(knots) < 2 or knots[0][0] != 0 or knots[-1][0] != 1 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs weights of 0 or more from t = 0 to t = 1")
    area = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:]))
    if area <= 0:
        raise ValueError("a schedule must not be 0 throughout")
    out, done = [], 0.0
    for (a, v), (b, w) in zip(knots, knots[1:]):
        part = (b - a) * (v + w) / 2 / area
        if part > 0:
            out.append((done, done + part, a, v / area, (w - v) / area / (b - a), part))
            done += part
    return out


#: As `total`: the largest mixture in which every source that has documents reaches its share.
WITHIN_REACH = -1


def plan(sized: DataFrame, targets: DataFrame, total: int | None = None) -> list[dict]:
    """For each target: what there is of its source, what it should give, and what it gives.

    total: size of the mixture in tokens, by default what there is of all target sources together, or WITHIN_REACH. A
    source that can't give its share even with max_repeats uses of each document gives all it can. Within reach the
    shares are of what sources with documents give, so that they reach theirs whatever targets have none.
    """
    named = targets.groupBy(source_name(F.col("source_name")).alias("name")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    there = sized.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))
    rows = named.join(there, F.col("name") == F.col("source"), "left").limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    there_share = 1.0
    if total == WITHIN_REACH:
        able = [r for r in rows if r.tokens and (r.max_repeats or 0) > 0 and (r.target_share or 0) > 0]
        there_share = sum(r.target_share for r in able) or 1.0
        total = int(min((r.tokens * r.max_repeats * there_share / r.target_share for r in able), default=0))
    total = sum(r.tokens or 0 for r in rows) if total is None else total
    out = []
    for r in sorted(rows, key=lambda r: r["name"] or ""):
        have, repeats = r.tokens or 0, max(0, r.max_repeats or 0)
        wanted = (r.target_share or 0.0) * total / there_share
        out.append({"source": r["name"], "target_share": r.target_share or 0.0, "max_repeats": repeats, "documents": r.documents or 0, "available": have, "wanted": wanted, "given": min(wanted, float(have * repeats))})
    return out


def mixture(sized: DataFrame, targets: DataFrame, total: int | None = None, schedules: dict[str, Schedule] | None = None, seed: int = 0) -> tuple[DataFrame, list[dict]]:
    """(doc_id, source, epoch, tokens, position) in the order of training, and the plan.

    sized: doc_id, source, tokens (stage it: it is read more than once). Within a source documents come in the
    order of a hash of their id, another in each epoch, until the source has given its tokens; the last one may
    pass the mark. No document is used more than max_repeats times. Documents of no size, of a NULL source or of
    a source without target aren't used. Targets without documents, with no share or no repeats give nothing;
    an empty table gives an empty mixture.
    """
    sized = sized.select("doc_id", source_name(F.col("source")).alias("source"), "tokens").where("tokens > 0")
    planned = plan(sized, targets, total)
    spark = sized.sparkSession
    rows, pieces = [], []
    for p in planned:
        if p["given"] > 0 and p["source"] is not None:
            rows.append((p["source"], int(-(-p["given"] // p["available"])), float(p["given"]), int(p["available"]), max(1, p["documents"] // BLOCK)))
            pieces += [(p["source"], *x) for x in _pieces((schedules or {}).get(p["source"], [(0.0, 1.0), (1.0, 1.0)]))]
    # Both tables have a few rows for each of at most MOST_TARGETS targets.
    uses = F.broadcast(spark.createDataFrame(rows, "of string, epochs int, given double, available bigint, blocks bigint"))
    curve = F.broadcast(spark.createDataFrame(pieces, "on string, u0 double, u1 double, t0 double, w0 double, slope double, part double"))
    drawn = sized.join(uses, F.col("source") == F.col("of")).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    drawn = drawn.withColumn("turn", F.xxhash64(F.lit(seed), "epoch", "doc_id")).withColumn("block", F.floor((F.col("turn") / F.lit(2.0**64) + 0.5) * F.col("blocks")))
    summed = blocked_scan(drawn, ["source", "epoch"], "block", "turn", sums={"through": "tokens"})
    begun = F.col("epoch") * F.col("available") + F.col("through") - F.col("tokens")
    placed = summed.withColumn("u", begun / F.col("given")).where("u < 1")
    rise = F.col("u") - F.col("u0")
    root = F.sqrt(F.greatest(F.col("w0") * F.col("w0") + 2 * F.col("slope") * rise, F.lit(0.0)))
    # The stable root of w0 x + slope x^2 / 2 = rise.
    position = F.col("t0") + F.when(rise <= 0, F.lit(0.0)).otherwise(2 * rise / (F.col("w0") + root))
    found = placed.join(curve, (F.col("source") == F.col("on")) & (F.col("u") >= F.col("u0")) & ((F.col("u") < F.col("u1")) | ((F.col("u1") > 0.999999) & (F.col("u") >= F.col("u1")))))
    out = found.select("doc_id", "source", "epoch", "tokens", position.alias("position"))
    return out.repartitionByRange("position", "source", "doc_id", "epoch").sortWithinPartitions("position", "source", "doc_id", "epoch"), planned


def shares(mixed: DataFrame, planned: list[dict]) -> DataFrame:
    """For each target: its share, what was drawn, the actual share, and the most uses of one document."""
    spark = mixed.sparkSession
    uses = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("tokens").alias("tokens"))
    drawn = uses.groupBy("source").agg(F.sum("tokens").alias("drawn_tokens"), F.count("*").alias("drawn_documents"), F.max("uses").alias("most_uses"))
    rows = [(p["source"], float(p["target_share"]), int(p["max_repeats"]), int(p["available"]), float(p["wanted"]), p["given"] >= p["wanted"]) for p in planned]
    table = spark.createDataFrame(rows, "source_name string, target_share double, max_repeats int, available_tokens bigint, wanted_tokens double, reachable boolean")
    joined = table.join(drawn, F.col("source_name") == F.col("source"), "left").drop("source").fillna(0, ["drawn_tokens", "drawn_documents", "most_uses"])
    # The table has at most MOST_TARGETS rows.
    total = F.sum("drawn_tokens").over(Window.partitionBy(F.lit(1)))
    return joined.withColumn("all_tokens", total).withColumn("actual_share", F.when(F.col("all_tokens") > 0, F.col("drawn_tokens") / F.col("all_tokens")).otherwise(0.0)).drop("all_tokens")


def sized_documents(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, source, tokens of every document, written once."""
    return stage(with_tokens(docs.select("doc_id", "source", "text"), path=path))
