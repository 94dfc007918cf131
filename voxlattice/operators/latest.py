"""Latest version of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], values: list[str], at: str = "loaded_at") -> DataFrame:
    """One row per key with the values of the row that has the greatest `at`.

    Rows are combined on the map side, so a key with any number of versions is no burden. A NULL `at` is the
    oldest; among rows with one greatest `at` the greatest values win (equal ones are one row). NULL keys are
    a key of their own; columns not named are dropped; an empty table gives an empty one.
    """
    best = F.max(F.struct(F.col(at).alias("_at"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best._v{i}").alias(v) for i, v in enumerate(values)])
