"""Ordered scans over keys of any size.

A plain window over a key puts all rows of that key into one task. Here every key is cut into blocks along its
order; windows run within (key, block), and only one summary row per block goes through a window over the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def blocked_scan(
    df: DataFrame,
    keys: list[str],
    block: str,
    order: str,
    sums: dict[str, str] | None = None,
    before: dict[str, str] | None = None,
    after: dict[str, str] | None = None,
) -> DataFrame:
    """Running values along `order` within `keys`, computed block by block.

    sums: new column -> number column, its sum up to and including the row. before, after: new column -> column,
    its last non-NULL value in an earlier row, or its first one in a later row. `block` must not decrease along
    `order`, which must be unique within the keys. One summary row per (key, block) passes through a window over
    the key, so blocks should hold thousands of rows. Rows whose key, block or order is NULL are left out; an
    empty table gives an empty one. The rows are shuffled once, and both branches read that shuffle.
    """
    sums, before, after = sums or {}, before or {}, after or {}
    along = F.col(order)
    total = (
        [F.sum(c).alias(f"_s_{n}") for n, c in sums.items()]
        + [F.max_by(c, F.when(F.col(c).isNotNull(), along)).alias(f"_b_{n}") for n, c in before.items()]
        + [F.min_by(c, F.when(F.col(c).isNotNull(), along)).alias(f"_a_{n}") for n, c in after.items()]
    )
    on = [*keys, block]
    df = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*on, order])).repartition(*on)
    by_key = Window.partitionBy(*keys).orderBy(block)
    earlier, later = by_key.rowsBetween(Window.unboundedPreceding, -1), by_key.rowsBetween(1, Window.unboundedFollowing)
    blocks = (
        df.groupBy(*on)
        .agg(*total)
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)],
            *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in sums],
            *[F.last(f"_b_{n}", True).over(earlier).alias(f"_b_{n}") for n in before],
            *[F.first(f"_a_{n}", True).over(later).alias(f"_a_{n}") for n in after],
        )
    )
    within = Window.partitionBy(*on).orderBy(order)
    up_to, prior, next_ = (
        within.rowsBetween(Window.unboundedPreceding, 0),
        within.rowsBetween(Window.unboundedPreceding, -1),
        within.rowsBetween(1, Window.unboundedFollowing),
    )
    made: dict[str, Column] = {n: F.col(f"_s_{n}") + F.coalesce(F.sum(c).over(up_to), F.lit(0)) for n, c in sums.items()}
    made |= {n: F.coalesce(F.last(c, True).over(prior), F.col(f"_b_{n}")) for n, c in before.items()}
    made |= {n: F.coalesce(F.first(c, True).over(next_), F.col(f"_a_{n}")) for n, c in after.items()}
    same = [df[k] == blocks[f"_k{i}"] for i, k in enumerate(on)]
    return df.join(blocks, same).select(*df.columns, *[c.alias(n) for n, c in made.items()])
