import hashlib
import math

import pytest
from pyspark.sql import functions as F

from hearthline.operators.split import content_key, fold_of, split_train_test


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 101, 5000])
@pytest.mark.parametrize("at_once", [3, 1_000_000])
def test_share_is_exact(spark, n, at_once):
    parts = split_train_test(spark.range(n), "id", ranked_at_once=at_once)
    ours = {r["id"] for r in parts.filter("split = 'test'").collect()}
    digests = sorted((hashlib.md5(f"13:{i}".encode()).hexdigest(), i) for i in range(n))
    assert ours == {i for _, i in digests[: math.ceil(0.2 * n)]}
    assert parts.count() == n


def test_partitioning_does_not_matter(spark):
    a = split_train_test(spark.range(1000).repartition(1), "id")
    b = split_train_test(spark.range(1000).repartition(9), "id")
    assert a.exceptAll(b).isEmpty()


def test_other_seed_other_rows(spark):
    a = split_train_test(spark.range(1000), "id", seed=1).filter("split = 'test'")
    b = split_train_test(spark.range(1000), "id", seed=2).filter("split = 'test'")
    assert a.count() == b.count() == 200
    assert not a.exceptAll(b).isEmpty()


def test_empty_and_all_train(spark):
    assert split_train_test(spark.range(0), "id").count() == 0
    none = split_train_test(spark.range(5), "id", test_share=0.0)
    assert none.filter("split = 'train'").count() == 5


def test_key_must_be_unique(spark):
    df = spark.range(10).select((F.col("id") * 0).alias("id"))
    with pytest.raises(ValueError, match="not unique"):
        split_train_test(df, "id")


def test_content_key_tells_nulls_and_columns_apart(frame):
    df = frame(
        [("a", None), (None, "a"), ("null", None), (None, None), ("", None)],
        "x string, y string",
    )
    assert df.select(content_key(df)).distinct().count() == 5


def test_folds_are_even_and_stable(spark):
    df = spark.range(10_000).select("id", fold_of(F.col("id")).alias("fold"))
    sizes = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1, 2, 3, 4}
    assert all(1800 < s < 2200 for s in sizes.values())
    again = spark.range(10_000).repartition(3).select("id", fold_of(F.col("id")).alias("fold"))
    assert again.exceptAll(df).isEmpty()
