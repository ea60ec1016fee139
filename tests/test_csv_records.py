from __future__ import annotations

import csv
import random

import pytest

from hearthline import sources
from hearthline.sources import csv_records
from hearthline.sources.csv_records import read_lines


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _write(path, rows, ending="\n"):
    with path.open("w", newline="") as f:
        out = csv.writer(f, lineterminator=ending)
        out.writerow(["id", "street", "note"])
        out.writerows(rows)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_blocks_give_what_one_task_gives(spark, small_blocks, tmp_path, ending):
    r = random.Random(5)
    cells = ["plain", 'a "quoted" word', "two\nlines", "\n", '"\n"', "x" * 900 + "\n" + "y" * 1300, "comma, here", ""]
    for name in ("a", "b"):
        rows = [(f"{name}{i}", r.choice(cells), r.choice(cells)) for i in range(120)]
        _write(tmp_path / f"{name}.csv", rows, ending)
    path = str(tmp_path / "*.csv")
    one_task = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    got = sources.read_listings_csv(spark, path, types={}, multi_line=True)
    assert read_lines(spark, path).select("file", "block").distinct().count() > 20
    want = sorted(map(tuple, one_task.collect()))
    assert sorted((x.id, x.street, x.note) for x in got.collect()) == want
    order = [x.id for x in got.where("id like 'b%'").orderBy("row_ord").collect()]
    assert order == [f"b{i}" for i in range(120)]


def test_an_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,street\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="open.csv"):
        sources.read_listings_csv(spark, str(tmp_path / "open.csv"), multi_line=True).collect()


def test_a_file_of_a_header_alone(spark, tmp_path):
    (tmp_path / "none.csv").write_text("id,street\n")
    assert sources.read_listings_csv(spark, str(tmp_path / "none.csv"), multi_line=True).count() == 0


def test_lines_stay_where_they_are_read(spark, small_blocks, tmp_path):
    """Of a block, the parts of two records at most are exchanged."""
    _write(tmp_path / "a.csv", [(i, "two\nlines" if i % 3 == 0 else "one", "x" * 50) for i in range(400)])
    lines = read_lines(spark, str(tmp_path / "a.csv"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = csv_records.read_records(spark, str(tmp_path / "a.csv"))
        assert records.count() == records.select("place").distinct().count() == 400
        assert "SortMergeJoin" not in records._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    blocks = csv_records._blocks(lines)
    parts = csv_records._put_together(lines, blocks, False)
    assert 0 < parts.count() <= 2 * blocks.count() < lines.count()


@pytest.mark.parametrize("rows", [1, 3, 10_000])
def test_records_of_any_batches(spark, small_blocks, tmp_path, rows):
    cells = ["a", "two\nlines", "\n\n\n\n\n\n", "x" * 1000 + "\n" + "y" * 1000]
    _write(tmp_path / "a.csv", [(i, cells[i % 4], cells[i * 7 % 3]) for i in range(60)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        got = sources.read_listings_csv(spark, str(tmp_path / "a.csv"), types={}, multi_line=True).orderBy("row_ord").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.id, r.street, r.note) for r in got] == [(str(i), cells[i % 4], cells[i * 7 % 3]) for i in range(60)]
