import pytest
from pyspark.sql import functions as F

from checks import inputs
from hearthline import jobs, sources
from hearthline import settings as S
from hearthline.plans import audit


@pytest.fixture(scope="module")
def files(spark, small, tmp_path_factory):
    """Raw listings and both lookups as the files a user has."""
    folder = tmp_path_factory.mktemp("jobs")
    raw = inputs.listings(spark, small)
    sources.write_table(raw, str(folder / "raw"), fmt="csv", order_col="row_ord")
    stats = inputs.commune_stats(spark, small).collect()
    at = sources.lookups.COMMUNE_STATS_POSITIONS
    lines = ["," * 21] * 3
    for r in stats:
        cells = [""] * 22
        for name, place in at.items():
            cells[place] = "" if r[name] is None else str(r[name])
        lines.append(",".join(cells))
    (folder / "communes.csv").write_text("\n".join(lines))
    codes = inputs.postal_map(spark, small).orderBy("ord").collect()
    (folder / "postal.csv").write_text(
        "Code INS Commune;Code postal\n"
        + "\n".join(f"{r['nis_code']};{r['postal_code']}" for r in codes)
    )
    return folder


def test_from_raw_files_to_scored_listings(spark, files, listings):
    at = {n: str(files / n) for n in ("audited", "clean", "report", "run", "scored")}
    jobs.main(["audit", "--raw", str(files / "raw"), "--out", at["audited"], "--report", at["report"]])
    audited = sources.read_table(spark, at["audited"])
    direct = audit(listings).listings
    assert "row_ord" not in audited.columns
    same = [F.col("property_id").cast("long"), "price", "latitude", "floor", "street"]
    assert audited.select(*same).exceptAll(direct.select(*same)).isEmpty()
    assert audited.count() == direct.count()
    report = {(r["step"], r["measure"]): r["rows"] for r in sources.read_table(spark, at["report"]).collect()}
    assert report["price", "rows_after"] == direct.count()

    jobs.main(["clean", "--audited", at["audited"], "--out", at["clean"], "--on-bad-date", "null"])
    cleaned = sources.read_table(spark, at["clean"])
    assert {"post_year", "post_month"} <= set(cleaned.columns)
    assert not set(S.DROPPED_COLUMNS) & set(cleaned.columns)

    done = jobs.train_job(
        spark, at["clean"], str(files / "postal.csv"), str(files / "communes.csv"), at["run"],
        "random_forest", numTrees=3, maxDepth=4,
    )
    assert sources.read_table(spark, f"{at['run']}/metrics").count() == 2
    assert sources.read_table(spark, f"{at['run']}/worst").count() == 10

    jobs.main(
        ["score", "--cleaned", at["clean"], "--postal", str(files / "postal.csv"), "--communes",
         str(files / "communes.csv"), "--model", f"{at['run']}/model", "--out", at["scored"]]
    )
    scored = sources.read_table(spark, at["scored"])
    assert scored.filter("predicted > 0").count() == scored.count() >= done.predictions.count()


def test_ordered_output_follows_the_input(spark, files):
    jobs.audit_job(spark, str(files / "raw"), str(files / "ordered"), fmt="csv", ordered=True)
    back = sources.read_listings_csv(spark, str(files / "ordered"))
    ids = [int(r[0]) for r in back.orderBy("row_ord").select("property_id").collect()]
    assert ids == sorted(ids)
