"""Reproducible train/test split and folds from a hash of the row key.

The hash decides, not the position of a row, so the split is the same for any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.settings import ENCODER_FOLDS, SEED, TEST_SHARE

_DIGITS = 3
RANKED_AT_ONCE = 1_000_000


def row_digest(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def content_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A key for rows without one: a digest of the whole row, nulls told apart from text."""
    names = list(columns or df.columns)
    return F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))


def fold_of(key: Column, folds: int = ENCODER_FOLDS, seed: int = SEED) -> Column:
    digits = F.substring(row_digest(F.concat(F.lit("fold:"), key.cast("string")), seed), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(folds)).cast("int")


def split_train_test(
    df: DataFrame,
    key: str,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    ranked_at_once: int = RANKED_AT_ONCE,
) -> DataFrame:
    """Add ``split``: exactly ``ceil(test_share * n)`` rows are "test".

    The rows with the smallest digests are the test rows. Counts by digest prefix lead to the
    one prefix in which the last test row lies; only its rows are ranked, and the rest is a
    filter on the digest. Only these rows, ``ranked_at_once`` at most as keys are unique, are ranked in
    one task; a repeated key at the cut is an error. Reads ``df`` a few times (the key alone), so
    pass a stored table.
    """
    digests = df.select(row_digest(F.col(key), seed).alias("digest"))
    prefix, wanted = "", None
    while True:
        length = len(prefix) + _DIGITS
        counts = (
            digests.filter(F.col("digest").startswith(prefix))
            .groupBy(F.substring("digest", 1, length).alias("prefix"))
            .count()
            .collect()  # at most 16 ** _DIGITS rows
        )
        if wanted is None:
            wanted = math.ceil(test_share * sum(r["count"] for r in counts))
            if wanted == 0:
                return df.withColumn("split", F.lit("train"))
        for r in sorted(counts, key=lambda r: r["prefix"]):
            if wanted <= r["count"]:
                break
            wanted -= r["count"]
        prefix, inside = r["prefix"], r["count"]
        if inside <= ranked_at_once or length + _DIGITS > 32:
            break

    ranked = digests.filter(F.col("digest").startswith(prefix)).withColumn(
        "nth", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("digest"))
    )
    edge = ranked.filter(F.col("nth").between(wanted, wanted + 1)).orderBy("nth").collect()
    cutoff = edge[0]["digest"]
    if len(edge) > 1 and edge[1]["digest"] == cutoff:
        raise ValueError(f"split key {key} is not unique")
    is_test = row_digest(F.col(key), seed) <= cutoff
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))
