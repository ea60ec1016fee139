"""Row numbers and group numbers without gaps, with no task that holds the table.

Rows are dealt into partitions by range of their key and numbered inside; each partition's number of
rows, one small row per partition, gives the offset of the next ones. Sorting is the only exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.sources.stages import stage


def _dealt(df: DataFrame, order: Sequence[Column], parts: int | None) -> DataFrame:
    """Stored rows with ``_part``, the range they lie in, and ``_in_part``, their place there from 1.

    Stored, because ranges come from a sample of the rows and must not be drawn twice.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    # One window per range; rows are there already, sorted by the same key.
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return stage(ranged.withColumn("_in_part", place), "numbered")


def _offsets(counts: DataFrame) -> DataFrame:
    """``_part, _before``: how many rows the partitions before hold. One row per partition passes one task."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_number", parts: int | None = None
) -> DataFrame:
    """``df`` with ``name``, the place of each row in ``order``, from 1 on and without gaps.

    Rows equal in ``order`` get their numbers in no set order, so give a key that is unique. Nulls come first.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    dealt = _dealt(df, order, parts)
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_rows"))
    placed = dealt.join(F.broadcast(_offsets(counts)), "_part")  # one row per partition
    return placed.select(*df.columns, (F.col("_before") + F.col("_in_part")).cast("long").alias(name))


def group_ids(df: DataFrame, keys: Sequence[str], name: str = "group_id", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``, the dense rank of its ``keys`` from 0 on; missing keys are equal, and come first.

    Distinct keys are numbered, combined in each task before they are exchanged, so a key that holds a
    third of all rows is one row there. Joining the numbers back is a plain join: Spark broadcasts few
    groups, and adaptive execution splits a large one.
    """
    named = {k: f"_key_{i}" for i, k in enumerate(keys)}
    groups = df.select(*[F.col(k).alias(v) for k, v in named.items()]).distinct()
    numbered = stage(number_rows(groups, list(named.values()), "_nth", parts), "group-ids")
    same = [F.col(k).eqNullSafe(F.col(v)) for k, v in named.items()]
    joined = df.join(numbered, same)
    return joined.select(*df.columns, (F.col("_nth") - 1).alias(name))
