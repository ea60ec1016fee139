"""The listings of the checks are made and written in tasks of bounded size."""

from __future__ import annotations

import datetime

import pytest

from checks import inputs, queries


@pytest.fixture
def given(spark, tmp_path):
    """A folder with 300 orders, some without a key or with the same one, of three customers."""
    day = datetime.date(2020, 1, 1)
    keys = [None, 7, 7, *range(10, 307)]
    orders = [(k, i % 3, 1000.0 * i, day, "FOP"[i % 3]) for i, k in enumerate(keys)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderstatus string"),
        "customer": ([(c, c, "BUILDING") for c in range(3)], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "nation": ([(n,) for n in range(3)], "n_nationkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_tasks_that_make_listings_grow_in_number_with_the_table(spark, given):
    made = inputs._made(spark, given, per_task=10)
    kinds = 3  # first, later and lesser postings
    assert made.rdd.getNumPartitions() == kinds * 30
    assert max(made.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= 10


def test_listings_are_those_of_the_sql(spark, given):
    told = spark.sql(inputs.LISTINGS, **{n: inputs.table(spark, given, n) for n in ("orders", "customer", "nation")})
    made = inputs.listings(spark, given)
    assert made.columns == told.columns and made.count() == told.count()
    assert made.exceptAll(told).isEmpty()


def test_line_breaks_are_written_in_more_files_for_more_rows(spark, given, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 100)
    written = []
    plain = queries.src.write_table

    def write_table(df, path, **options):
        written.append(df.rdd.getNumPartitions())
        plain(df, path, **options)

    monkeypatch.setattr(queries.src, "write_table", write_table)
    back = queries.listings_csv_line_breaks(spark, given)
    wanted = inputs.listings(spark, given)
    assert written == [4]
    assert back.count() == wanted.count() > 300
    cells = ("epc", "availability")
    assert back.select("property_id", *cells).exceptAll(wanted.select("property_id", *cells)).isEmpty()
