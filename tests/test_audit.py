import pytest
from pyspark.sql import functions as F

from hearthline import settings as S
from hearthline.operators import coordinates, dedup, nulling, prices
from hearthline.operators.audit_report import audit_report, coordinate_flags
from hearthline.plans import audit
from hearthline.settings import Limits
from tests.conftest import values


def test_swap_exchanges_stored_values(frame):
    df = frame(
        [
            (1, 4.35, 50.85), (2, 50.85, 4.35), (3, 2.5, 49.5), (4, 6.5, 51.6), (5, 6.51, 50.0),
            (6, None, 50.0), (7, 4.0, None),
        ],
        "id int, latitude double, longitude double",
    )
    once = coordinates.swap_coordinates(df)
    assert values(once) == [
        (1, 50.85, 4.35), (2, 50.85, 4.35), (3, 49.5, 2.5), (4, 51.6, 6.5), (5, 6.51, 50.0),
        (6, None, 50.0), (7, 4.0, None),
    ]
    assert values(coordinates.swap_coordinates(once)) == values(once)


def test_swap_of_text_keeps_the_text(frame):
    df = frame([(1, "4.350", "50.850")], "id int, latitude string, longitude string")
    assert values(coordinates.swap_coordinates(df)) == [(1, "50.850", "4.350")]


def test_invalid_coordinates(frame):
    df = frame(
        [
            (1, "50", "4"), (2, "10", "4"), (3, "50", "60"), (4, "10", None), (5, None, "60"),
            (6, "49.5", "6.5"), (7, "x", "60"),
        ],
        "id int, latitude string, longitude string",
    )
    assert values(coordinates.null_invalid_coordinates(df)) == [
        (1, 50.0, 4.0), (2, None, None), (3, None, None), (4, 10.0, None), (5, None, 60.0),
        (6, 49.5, 6.5), (7, None, 60.0),
    ]


ROW = "id int, livable_surface string, garages string, facades int, number_of_floors double, floor int"


def test_implausible_values_at_the_limits(frame):
    df = frame(
        [
            (1, "11.99", "5", 5, 51.0, 51),
            (2, "12", "4", 4, 50.0, 50),
            (3, "x", None, None, None, 50),
            (4, "12", "0", 1, 3.0, 4),
            (5, "12", "0", 1, 3.0, 3),
            (6, "12", "0", 1, 51.0, 40),
            (7, "12", "0", 1, 3.0, None),
        ],
        ROW,
    )
    assert values(nulling.null_implausible(df)) == [
        (1, None, None, None, None, None),
        (2, 12.0, 4.0, 4.0, 50.0, 50.0),
        (3, None, None, None, None, 50.0),
        (4, 12.0, 0.0, 1.0, 3.0, None),
        (5, 12.0, 0.0, 1.0, 3.0, 3.0),
        (6, 12.0, 0.0, 1.0, None, 40.0),
        (7, 12.0, 0.0, 1.0, 3.0, None),
    ]
    hits = nulling.count_implausible(df).first().asDict()
    assert hits == {
        "livable_surface_below_min": 1, "garages_above_max": 1, "facades_above_max": 1,
        "number_of_floors_above_max": 2, "floor_above_max": 1,
        "floor_above_number_of_floors": 1, "floor_nulled": 2,
    }


def test_rules_one_by_one_match_all_at_once(listings):
    stepwise = listings
    for rule in (
        nulling.null_invalid_livable_surface, nulling.null_invalid_garages,
        nulling.null_invalid_facades, nulling.null_invalid_total_floor, nulling.null_invalid_floor,
    ):
        stepwise = rule(stepwise)
    assert stepwise.exceptAll(nulling.null_implausible(listings)).isEmpty()
    assert stepwise.count() == listings.count()


def test_floor_rule_alone_uses_the_stored_total(frame):
    df = frame([(1, "1", "1", 1, 60.0, 55), (2, "1", "1", 1, 45.0, 48)], ROW)
    assert values(nulling.null_invalid_floor(df), "id", "floor") == [(1, None), (2, None)]


def test_price_limits(frame):
    rows = [(i, str(30000 + i)) for i in range(101)]
    rows += [(200, "29999"), (201, "0"), (202, "-5"), (203, "free"), (204, None)]
    df = frame(rows, "id int, price string")
    # 104 prices: rank 0.99 * 103 = 101.97, between 30098 and 30099.
    cap = prices.price_cap(df)
    assert cap == pytest.approx(30098.97)
    kept = prices.remove_invalid_price(df)
    assert values(kept) == [(i, float(30000 + i)) for i in range(99)]
    found = df.agg(
        *[F.count_if(hit).alias(n) for n, hit in prices.price_findings(df, cap).items()]
    ).first()
    assert found.asDict() == {
        "price_missing": 2, "price_not_positive": 2, "price_below_min": 1, "price_above_cap": 2,
    }


def test_price_equal_to_the_cap_stays(frame):
    df = frame([(i, 50000.0) for i in range(50)] + [(99, 60000.0)], "id int, price double")
    kept = prices.remove_invalid_price(df, limits=Limits(price_quantile=0.5))
    assert kept.count() == 50


def test_no_price_at_all(frame):
    df = frame([(1, None), (2, "x")], "id int, price string")
    assert prices.price_cap(df) is None
    assert prices.remove_invalid_price(df).count() == 0


def test_price_filter_reaches_the_scan(listings):
    done = audit(listings)
    plan = done.listings.select("price")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<price:double>" in plan
    assert "GreaterThanOrEqual(price,30000.0)" in plan
    assert "Exchange" not in plan


def test_nan_price_is_no_price(frame):
    df = frame([(1, float("nan")), (2, 40000.0), (3, 50000.0)], "id int, price double")
    assert prices.price_cap(df) == 49900.0
    assert values(prices.remove_invalid_price(df)) == [(2, 40000.0)]


def test_audit_does_not_depend_on_partitioning(listings):
    one = audit(listings.repartition(1))
    many = audit(listings.repartition(7))
    assert one.cap == many.cap
    assert one.listings.exceptAll(many.listings).isEmpty()
    assert one.listings.count() == many.listings.count()


def test_report_uses_the_given_limits(listings):
    limits = S.Limits(min_price=200_000, min_surface=100, max_garages=2)
    done = audit(listings, limits=limits)
    rows = {(r["step"], r["measure"]): r["rows"] for r in done.report.collect()}
    price = F.col("price")
    assert rows["price", "price_below_min"] == done.deduplicated.filter((price > 0) & (price < 200_000)).count()
    assert rows["price", "rows_after"] == done.listings.count()
    kept = done.deduplicated.filter((price >= 200_000) & (price <= done.cap))
    assert rows["implausible", "livable_surface_below_min"] == kept.filter("livable_surface < 100").count()
    assert rows["implausible", "garages_above_max"] == kept.filter("garages > 2").count()


def test_report_and_duplicates_agree_on_nan_and_spelling(listings):
    odd = listings.limit(50).withColumns({
        "livable_surface": F.when(F.col("row_ord") % 2 == 0, F.lit(float("nan"))).cast("double"),
        "price": F.when(F.col("row_ord") % 3 == 0, F.lit("50000.0")).otherwise(F.lit("50000")),
    })
    same = odd.drop(*[c for c in odd.columns if c not in ("property_id", "row_ord", "date_posted", "price", "livable_surface",
        "latitude", "longitude", "garages", "facades", "number_of_floors", "floor")])
    flat = same.withColumns({c: F.lit(4.0) for c in ("garages", "facades", "number_of_floors", "floor")}).withColumns(
        {"latitude": F.lit(50.0), "longitude": F.lit(4.0)})
    flagged, flags = coordinate_flags(flat)
    keys = dedup.row_keys(flagged, groups=["safe"], flags=flags)
    priced = flat.withColumn("price", F.col("price").cast("double"))
    report = audit_report(keys, dedup.repeated_rows(keys, "safe"), priced, 60000.0)
    rows = {(r["step"], r["measure"]): r["rows"] for r in report.collect()}
    assert rows["safe_duplicates", "rows_after"] == dedup.remove_safe_duplicates(flat).count() == 1


def test_report_reads_each_stored_table_once(listings):
    done = audit(listings)
    plan = done.report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 3


def test_report_adds_up(listings):
    done = audit(listings)
    rows = {(r["step"], r["measure"]): r["rows"] for r in done.report.collect()}
    assert rows["coordinates", "rows_in"] == listings.count()
    price = [v for (s, m), v in rows.items() if s == "price" and m != "rows_after"]
    assert rows["suspicious_duplicates", "rows_after"] - sum(price) == rows["price", "rows_after"]
    assert done.listings.count() == rows["price", "rows_after"]
