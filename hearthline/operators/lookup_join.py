"""Left join to a lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_lookup(df: DataFrame, key: str, what: str) -> DataFrame:
    """One row per key; a key with two rows is an error, as a join would multiply listings.

    The error is raised by the query that reads the lookup, in the same pass; no job runs here.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.first(F.col(f"`{c}`")).alias(c) for c in rest]
    )
    message = F.concat(F.lit(f"{what}: {key} "), F.col(key).cast("string"), F.lit(" has several rows"))
    checked = F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.col(key))
    return grouped.select(checked.cast(df.schema[key].dataType).alias(key), *rest)


def lookup_join(df: DataFrame, lookup: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join on a key that is unique in ``lookup``.

    Spark broadcasts the lookup if its bytes stay below ``spark.sql.autoBroadcastJoinThreshold``,
    measured at run time. Else both sides are shuffled, and adaptive execution splits the partition of a
    hot key, or of all rows without a match, into as many tasks as its size asks for; nothing here
    depends on a fixed number of tasks. No job runs before the result is read.
    """
    return df.join(lookup, [key] if isinstance(key, str) else list(key), "left")
