from pathlib import Path
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hearthline import settings as S
from hearthline import sources
from tests.conftest import values


def test_raw_scan(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text(
        "property_id,price,bedrooms,garden,street,epc,extra,vat\n"
        '1,250000,2,1,"Rue ""X"", 5",NA,a,1.0\n'
        '2,on demand,n/a,0,"two\nlines",None,,0\n'
        "3, 30000.0 ,3.0,x, spaced ,<NA>,NULL,yes\n"
        "4,,,,,,,\n"
    )
    df = sources.read_listings_csv(spark, str(file), multi_line=True)
    assert df.columns[-2:] == ["vat", "row_ord"] and len(df.columns) == 9
    kinds = dict(df.dtypes)
    assert kinds["bedrooms"] == kinds["garden"] == "double" and kinds["vat"] == "string"
    got = df.orderBy("row_ord").drop("row_ord").collect()
    assert [tuple(r) for r in got] == [
        ("1", "250000.0", 2.0, 1.0, 'Rue "X", 5', None, "a", "1"),
        ("2", "on demand", None, 0.0, "two\nlines", None, None, "0"),
        ("3", "30000.0", 3.0, None, " spaced ", None, None, "yes"),
        ("4", None, None, None, None, None, None, None),
    ]


def test_every_missing_token(spark, tmp_path):
    file = tmp_path / "raw.csv"
    lines = "\n".join(f'{i},"{t}"' for i, t in enumerate(S.MISSING_TOKENS))
    file.write_text(f"property_id,street\n{lines}\n99,Nano\n")
    df = sources.read_listings_csv(spark, str(file))
    assert df.filter("street IS NOT NULL").count() == 1
    assert df.count() == len(S.MISSING_TOKENS) + 1


def test_row_order_over_many_files(spark, tmp_path):
    for part in range(5):
        # The largest file last by name, which Spark would pack first.
        rows = range(part * 1000, part * 1000 + 10 * (part + 1))
        (tmp_path / f"part-{part}.csv").write_text(
            "property_id,price\n" + "\n".join(f"{i},1" for i in rows) + "\n"
        )
    df = sources.read_listings_csv(spark, str(tmp_path))
    ids = [int(r[0]) for r in df.orderBy("row_ord").select("property_id").collect()]
    assert ids == sorted(ids) and len(ids) == 150


def test_write_and_read_back(spark, frame, tmp_path):
    df = frame([(2, " a ", None), (1, 'b"c', 1.5)], "row_ord int, street string, price double")
    sources.write_table(df, str(tmp_path / "p"))
    assert values(sources.read_table(spark, str(tmp_path / "p"))) == values(df)
    assert sources.read_table(spark, str(tmp_path / "p"), ["street"]).columns == ["street"]
    sources.write_table(df, str(tmp_path / "c"), fmt="csv", order_col="row_ord")
    back = sources.read_listings_csv(spark, str(tmp_path / "c"), types={"price": "double"})
    got = [tuple(r) for r in back.orderBy("row_ord").drop("row_ord").collect()]
    assert got == [('b"c', 1.5), (" a ", None)]
    with pytest.raises(ValueError):
        sources.write_table(df, str(tmp_path / "x"), fmt="xlsx")


def test_commune_stats(spark, tmp_path):
    def line(nis, year, hc, hm, ac, am):
        cells = ["-"] * 24
        for at, v in zip((0, 2, 5, 6, 20, 21), (nis, year, hc, hm, ac, am)):
            cells[at] = v
        return ",".join(cells)

    file = tmp_path / "communes.csv"
    file.write_text(
        "\n".join(
            [
                "title" + "," * 23, "," * 23, line("nis", "year", "n", "median", "n", "median"),
                line("21004", "2025", "10", "300000", "5", "x"),
                line("21004", "2024", "11", "290000", "6", "210000"),
                line("total", "2025", "1", "1", "1", "1"),
                line("22001", "2025", "", "", "4", "150000.5"),
            ]
        )
    )
    got = sources.read_commune_stats(spark, str(file))
    assert values(got) == [
        (21004.0, 2025.0, 10.0, 300000.0, 5.0, None), (22001.0, 2025.0, None, None, 4.0, 150000.5),
    ]
    assert sources.read_commune_stats(spark, str(file), year=2024).count() == 1


def test_postal_map(spark, tmp_path):
    file = tmp_path / "codes.csv"
    file.write_text(
        "Code INS Commune;Commune;Code postal\n"
        "21004;Bruxelles; 1000 \n21015;Other;1000\n21015;Schaerbeek;1030\n"
    )
    got = sources.read_postal_map(spark, str(file))
    assert values(got, "postal_code", "nis_code") == [("1000", 21004.0), ("1030", 21015.0)]


def test_first_per_key_ignores_partitioning(spark):
    df = spark.range(900).select((F.col("id") % 9).alias("k"), F.col("id").alias("ord"))
    got = sources.first_per_key(df.repartition(7), "k", "ord")
    assert values(got, "k", "ord") == [(i, i) for i in range(9)]


class _Session:
    """As much of a session as finding the folder needs."""

    def __init__(self, master, setting=None):
        self.conf = SimpleNamespace(get=lambda key, default=None: setting or default)
        self.folder = None
        self.sparkContext = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: self.folder,
            setCheckpointDir=lambda folder: setattr(self, "folder", folder),
        )


def test_shared_folder_comes_from_the_session():
    session = _Session("yarn", "hdfs://nn/shared/")
    assert sources.shared_folder(session) == "hdfs://nn/shared"
    assert session.folder == "hdfs://nn/shared/"


def test_a_cluster_gets_no_folder_of_its_own():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sources.shared_folder(_Session("yarn"))


def test_executors_of_their_own_need_the_setting():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sources.shared_folder(_Session("local-cluster[2,1,1024]"))


def test_scratch_removes_its_tables(spark, tmp_path):
    outer = sources.stage(spark.range(2), "kept")
    with pytest.raises(KeyError), sources.scratch(spark):
        inner = sources.stage(spark.range(3), "gone")
        folder = Path(inner.inputFiles()[0].removeprefix("file:")).parent
        assert folder.exists()
        raise KeyError
    assert not folder.exists() and outer.count() == 2


def test_broken_rows_are_an_error_unless_lines_may_break(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,street,price\n1,"two\nlines",5\n2,x,6\n')
    read = lambda **o: sources.read_listings_csv(spark, str(tmp_path / "a.csv"), types={}, **o)
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed"):
        read().select("id").collect()
    assert sorted(r.street for r in read(multi_line=True).collect()) == ["two\nlines", "x"]


def test_a_local_session_keeps_one_folder():
    session = _Session("local[2]")
    assert sources.shared_folder(session) == sources.shared_folder(session) == session.folder


def test_stage_writes_to_the_shared_folder(spark):
    staged = sources.stage(spark.range(5), "ids")
    assert sources.shared_folder(spark).removeprefix("file:") in staged.inputFiles()[0]
    assert staged.count() == 5


def test_raw_types_cover_the_features():
    types = sources.raw_types()
    assert types["bedrooms"] == "double" and types["garden"] == "double" and types["vat"] == "code"
    assert "price" not in types and "property_age" not in types
