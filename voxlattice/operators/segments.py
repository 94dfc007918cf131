"""Numbering, intervals, links and joins of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlattice.functions.similarity import dice, edit_similarity
from voxlattice.functions.text import swap_suffix
from voxlattice.operators.ordered import blocked_scan


def ordinal_name(prefix: Column, number: Column) -> Column:
    """W-02: PFX_001; numbers beyond 999 keep all their digits."""
    return F.format_string("%s_%03d", prefix, number)


def numbered(df: DataFrame, keys: list[str], order: list[str], to: str = "seg_no", first: int = 0) -> DataFrame:
    """W-01, W-04: df with the place of each row in its file. For files of bounded size, as indexes are."""
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1 + first)


def with_ends(df: DataFrame, keys: list[str], order: list[str], start: str, to: str = "end") -> DataFrame:
    """W-03: df with the start of the next segment as this one's end; the last is open (NULL)."""
    return df.withColumn(to, F.lead(start).over(Window.partitionBy(*keys).orderBy(*order)))


def link_continuations(df: DataFrame, key: str, number: str, start: str, cont: str, to: str = "prev") -> DataFrame:
    """J-01: df with the number of the segment that names this one's start as its continuation; of several the last.

    All segments with that start are hit. The comparison is of the codes as they are written.
    """
    pointing = df.where(F.col(cont).isNotNull() & (F.col(cont) != "")).groupBy(F.col(key).alias("_k"), F.col(cont).alias("_c")).agg(F.max(number).alias("_n"))
    kept = df.drop(to)
    return kept.join(pointing, (kept[key] == pointing["_k"]) & (kept[start] == pointing["_c"]), "left").withColumn(to, F.col("_n")).drop("_k", "_c", "_n")


def merged_chains(df: DataFrame, key: str, number: str, prev: str, text: str, sep: str = " ") -> DataFrame:
    """J-02, A-11: roots with the texts of all segments that continue them, in order of number, and their members.

    Links to a segment that isn't earlier are ignored, so links of this kind have no cycles. The rounds double the
    distance, so a chain of n links takes log2(n) of them.
    """
    from voxlattice.operators.hierarchy import hierarchy

    safe = df.withColumn("_p", F.when(F.col(prev) < F.col(number), F.col(prev)))
    tree = hierarchy(safe, key, number, "_p").select(F.col(key).alias("_k"), F.col(number).alias("_n"), "root")
    rooted = df.join(tree, (F.col(key) == F.col("_k")) & (F.col(number) == F.col("_n")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), F.coalesce(text, F.lit("")).alias("t"))))
    return rooted.groupBy(key, F.col("root").cast("int").alias(number)).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), sep).alias(text), F.array_join(F.transform(ordered, lambda x: x["n"].cast("string")), ",").alias("members"))


def parent_names(df: DataFrame, key: str, number: str, prev: str, name: str) -> DataFrame:
    """J-15: key, number, parent_name of rows whose parent is there; others are left out."""
    parents = df.select(F.col(key).alias("_k"), F.col(number).alias("_n"), F.col(name).alias("parent_name"))
    return df.join(parents, (F.col(key) == F.col("_k")) & (F.col(prev) == F.col("_n"))).select(key, number, "parent_name")


def zip_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[Column], right_order: list[Column], right_columns: list[str]) -> DataFrame:
    """J-03: the i-th row of left gets the i-th row of right within the keys; left rows beyond stay with NULLs.

    Rows of right beyond are the caller's to report (see unzipped()).
    """
    a = left.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*left_order)))
    b = right.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*right_order))).select(*keys, "_at", *right_columns)
    return a.join(b, [*keys, "_at"], "left").drop("_at")


def unzipped(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys and extra: how many more rows right has than left, where it has more."""
    a, b = left.groupBy(*keys).agg(F.count("*").alias("_l")), right.groupBy(*keys).agg(F.count("*").alias("_r"))
    return b.join(a, keys, "left").select(*keys, (F.col("_r") - F.coalesce("_l", F.lit(0))).alias("extra")).where("extra > 0")


def filled_speakers(df: DataFrame, keys: list[str], order: str, explicit: str, placeholder: str, to: str = "speaker") -> DataFrame:
    """W-05: the last explicit label so far, before any the first placeholder of the file. In blocks, for files of any size."""
    blocked = df.withColumn("_block", F.floor(F.col(order) / 4096)).withColumn("_at", F.when(F.col(placeholder).isNotNull(), F.col(order)))
    filled = blocked_scan(blocked, keys, "_block", order, before={"_last": explicit})
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(placeholder, F.when(F.col(placeholder).isNotNull(), F.col(order))).alias("_first"), F.min(F.when(F.col(placeholder).isNotNull(), F.col(order))).alias("_from"))
    same = [filled[k] == first[f"_k{i}"] for i, k in enumerate(keys)]
    held = F.when(F.col(order) >= F.col("_from"), F.col("_first"))
    return filled.join(first, same, "left").withColumn(to, F.coalesce(explicit, "_last", held)).select(*df.columns, to)


def merged_labels(df: DataFrame, keys: list[str], order: str, text: str, is_label: Column) -> DataFrame:
    """W-10: a label alone is joined to the row after it unless that is a label too."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_label", is_label).withColumn("_after", F.lead(text).over(w)).withColumn("_after_label", F.lead(is_label).over(w))
    takes = F.col("_label") & F.col("_after").isNotNull() & ~F.col("_after_label")
    taken = marked.withColumn("_takes", takes).withColumn("_taken", F.coalesce(F.lag(takes).over(w), F.lit(False)))
    return taken.where("NOT _taken").withColumn(text, F.when(F.col("_takes"), F.concat_ws(" ", text, "_after")).otherwise(F.col(text))).select(*df.columns)


def best_matches(left: DataFrame, right: DataFrame, keys: list[str], least: float, by: str = "edit") -> DataFrame:
    """J-06, O-06: for each left row the most similar right row of its keys, if its similarity is `least` or more.

    left: keys, l_pos, l_norm; right: keys, r_pos, r_norm. by: edit (strings) or dice (arrays of tokens). Equal ones
    prefer the earlier. For edits, pairs whose lengths alone forbid `least` are dropped before distances are taken.
    """
    pairs = left.join(right, keys)
    if by == "edit":
        a, b = F.length("l_norm"), F.length("r_norm")
        pairs = pairs.where((a > 0) & (b > 0) & (1 - F.abs(a - b) / F.greatest(a, b) >= least))
        sim = edit_similarity(F.col("l_norm"), F.col("r_norm"), normalised=True)
    else:
        sim = dice(F.col("l_norm"), F.col("r_norm"))
    scored = pairs.withColumn("sim", sim).where(F.col("sim") >= least)
    best = F.max(F.struct(F.col("sim").alias("s"), (-F.col("r_pos")).alias("r"))).alias("b")
    return scored.groupBy(*keys, "l_pos").agg(best).select(*keys, "l_pos", (-F.col("b.r")).alias("r_pos"), F.col("b.s").alias("sim"))


def first_seen(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """A-09: the first row of each key; rows are combined before the shuffle."""
    rest = [c for c in df.columns if c not in (*key, order)]
    kept = F.min_by(F.struct(*rest), order).alias("_x") if rest else F.lit(1).alias("_x")
    return df.groupBy(*key).agg(F.min(order).alias(order), kept).select(*key, order, *([f"_x.{c}" for c in rest]))


def ordered_distinct(df: DataFrame, keys: list[str], norm: str, orig: str, order: str) -> DataFrame:
    """A-14: one row per norm with its first place and its last original."""
    return df.groupBy(*keys, norm).agg(F.min(order).alias(order), F.max_by(orig, order).alias(orig))


def rotated(position: Column, size: Column, shift: Column) -> Column:
    """W-06: the place of an item after the list is rotated by shift."""
    return F.pmod(position + size - shift, size)


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """F-09, J-14, U-05: left rows without a right one."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def used(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """J-14, J-16: left rows with a right one."""
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def srt_name(name: Column) -> Column:
    """J-04: the SRT file that belongs to a clip."""
    return swap_suffix(name, ".srt")


def banded_pairs(vectors: DataFrame, group: str, pos: str, vector: str, other: DataFrame, window: int = 5) -> DataFrame:
    """J-11 candidates: group, i, j, a, b of vectors whose places, one side scaled to the other's length, are within the window.

    Each row meets only the rows of its own and the neighbouring bands, so a group is never joined with itself whole.
    """
    size = lambda df, to: df.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias(to))
    n, m = size(vectors, "_n"), size(other, "_m")
    a = vectors.join(n, F.col(group) == F.col("_g")).drop("_g").join(m, F.col(group) == F.col("_g")).select(F.col(group).alias("g"), F.col(pos).alias("i"), F.col(vector).alias("a"), (F.col(pos) * F.col("_m") / F.col("_n")).alias("x"))
    wide = 2 * window + 1
    bands = F.array_distinct(F.array(F.floor((F.col("x") - window) / wide), F.floor(F.col("x") / wide), F.floor((F.col("x") + window) / wide)))
    b = other.select(F.col(group).alias("h"), F.col(pos).alias("j"), F.col(vector).alias("b"), F.floor(F.col(pos) / wide).alias("k2"))
    met = a.withColumn("k1", F.explode(bands)).join(b, (F.col("g") == F.col("h")) & (F.col("k1") == F.col("k2")))
    return met.where(F.abs(F.col("x") - F.col("j")) <= window).select(F.col("g").alias(group), "i", "j", "a", "b")
