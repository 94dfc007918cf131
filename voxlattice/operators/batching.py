"""Batches of clips bounded by number and by seconds, padding and masks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType


def duration_batches(items: DataFrame, keys: list[str], pos: str, duration: str, most_items: int = 32, most_seconds: float = 180.0) -> DataFrame:
    """W-07: keys, pos, duration, batch_no, place: items by duration, ties by pos, in batches that close when they hold
    most_items or when the next item would take them beyond most_seconds; one that is too long alone is a batch.

    The rule is sequential, so each value of keys is scanned in one task, in a stream of sorted rows that is never held:
    give shards (say recordings). Items without duration are left out.
    """
    kinds = [items.schema[k] for k in keys]
    schema = StructType([*kinds, StructField(pos, LongType()), StructField(duration, DoubleType()), StructField("batch_no", IntegerType()), StructField("place", IntegerType())])
    known = items.select(*keys, F.col(pos).cast("bigint").alias(pos), F.col(duration).cast("double").alias(duration)).where(F.col(duration).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, held, seconds = None, 0, 0, 0.0
        for batch in batches:
            numbers, places = [], []
            of = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys))))) if keys else [()] * batch.num_rows
            for key, d in zip(of, batch.column(len(keys) + 1).to_pylist()):
                if key != now:
                    now, number, held, seconds = key, 0, 0, 0.0
                elif held >= most_items or seconds + d > most_seconds:
                    number, held, seconds = number + 1, 0, 0.0
                numbers.append(number)
                places.append(held)
                held, seconds = held + 1, seconds + d
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32()), pa.array(places, pa.int32())], [*keys, pos, duration, "batch_no", "place"])

    return known.repartition(*keys).sortWithinPartitions(*keys, duration, pos).mapInArrow(run, schema)


def shuffled(batches: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """O-07: the batches with `turn`, their place in an order drawn by seed; each shard of keys has its own."""
    one = batches.select(*keys, "batch_no").distinct()
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(seed), *keys, "batch_no"), "batch_no")) - 1
    return batches.join(one.withColumn("turn", turn), [*keys, "batch_no"])


def batch_estimate(items: DataFrame, keys: list[str], duration: str, most_items: int = 32, most_seconds: float = 180.0) -> DataFrame:
    """A-10: keys, batches: the lower bound from seconds and from items, 1 at least."""
    by_seconds = F.ceil(F.sum(duration) / max(most_seconds, 1e-6))
    by_items = F.ceil(F.count("*") / max(most_items, 1))
    return items.groupBy(*keys).agg(F.greatest(by_seconds, by_items, F.lit(1)).alias("batches"))


def padded(values: Column, size: Column, fill: float = 0.0) -> Column:
    """L-02: an array lengthened to size."""
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(size - F.size(values), F.lit(0)).cast("int")))


def mask(values: Column, size: Column) -> Column:
    """L-02: true where a padded array has values."""
    return F.when(size > 0, F.transform(F.sequence(F.lit(1), size.cast("int")), lambda i: i <= F.size(values))).otherwise(F.array().cast("array<boolean>"))


def ctc_text(ids: Column, symbols: Column, blank: int = 0) -> Column:
    """X-09: symbols of the best path with repeats collapsed and blanks dropped."""
    start = F.struct(F.lit(-1).alias("last"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        said = F.when((x != acc["last"]) & (x != blank), F.concat(acc["out"], F.element_at(symbols, x + 1))).otherwise(acc["out"])
        return F.struct(x.alias("last"), said.alias("out"))

    return F.aggregate(F.transform(ids, lambda x: x.cast("int")), start, add, lambda acc: acc["out"])
