"""One query per operator, over whole tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import commune_stats, listings, postal_map, table
from hearthline import functions as fn
from hearthline import settings as S
from hearthline import sources as src
from hearthline.ml import encoders, evaluate, training
from hearthline.ml.models import linear_regression
from hearthline.operators import columns as cols
from hearthline.operators import coordinates as coord
from hearthline.operators import dedup, features, nulling, prices
from hearthline.operators.enrich import (
    add_commune_code,
    count_enriched,
    enrich_with_commune_stats,
)
from hearthline.operators.lookup_join import lookup_join
from hearthline.operators.numbering import group_ids, number_rows
from hearthline.operators.quantiles import exact_quantiles
from hearthline.operators.split import fold_of, split_train_test
from hearthline.plans import audit, clean, engineer_features, prepare_cv, prepare_training
from hearthline.plans.prepare import ROW_KEY

Query = Callable[[SparkSession, str], DataFrame]

ID = "property_id"
NUMBERS = (
    "latitude", "longitude", "bedrooms", "livable_surface", "floor", "build_year", "facades",
    "garages", "number_of_floors",
)
HOT = ("property_type", "category", "availability")
ALIKE = ("street", "category", "epc")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{src.shared_folder(spark)}/checks/{name}-{uuid.uuid4().hex}"


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    return src.tidy_commune_stats(commune_stats(spark, sf))


def _postal(spark: SparkSession, sf: str) -> DataFrame:
    return src.tidy_postal_map(postal_map(spark, sf), "ord").drop("ord")


# --- sources and sinks -------------------------------------------------------


def listings_csv_scan(spark, sf):
    path = _folder(spark, "listings-csv")
    src.write_table(listings(spark, sf), path, fmt="csv", order_col="row_ord")
    back = src.read_listings_csv(spark, path)
    kept = ("price", "epc", "street", "availability", "indoor_parking", "date_posted")
    return back.select(
        F.col(ID).cast("long").alias(ID),
        *[F.col(c) for c in kept if c not in ("price", "indoor_parking")],
        *[fn.to_number(back, c).alias(c) for c in ("price", "indoor_parking", *NUMBERS)],
    )


#: Rows per CSV file: several blocks of it, and no more for one task to write however large the table.
ROWS_PER_FILE = 500_000


def listings_csv_line_breaks(spark, sf):
    """Files whose cells hold line breaks and quotes, each read in several tasks; a small table is one file."""
    path = _folder(spark, "listings-line-breaks")
    broken = F.expr("CASE WHEN property_id % 3 = 0 THEN concat(street, '\\n\\n\"bus\" ', property_id, '\\n') ELSE street END")
    rows = listings(spark, sf)
    files = max(1, math.ceil(rows.count() / ROWS_PER_FILE))
    rows = rows.withColumn("street", broken).coalesce(files)
    src.write_table(rows.drop("row_ord"), path, fmt="csv")
    back = src.read_listings_csv(spark, path, multi_line=True)
    return back.select(
        F.col(ID).cast("long").alias(ID), "street", "epc", "availability", fn.to_number(back, "price").alias("price")
    )


def audited_table_roundtrip(spark, sf):
    path = _folder(spark, "listings")
    src.write_table(listings(spark, sf), path)
    return src.read_table(spark, path, [ID, "price", "category", "livable_surface"])


def listings_in_order(spark, sf):
    path = _folder(spark, "ordered")
    src.write_table(listings(spark, sf).select(ID, "row_ord"), path, order_col="row_ord")
    back = src.with_row_order(src.read_table(spark, path))
    numbered = number_rows(back, ["row_ord"], "nth")
    return numbered.select(ID, (F.col("nth") - 1).alias("place"))


def group_numbers(spark, sf):
    """Dense numbers of the look-alike texts of listings, missing ones equal."""
    df = listings(spark, sf).select(ID, *[fn.normalised(F.col(c)).alias(c) for c in ALIKE])
    return group_ids(df, ALIKE).select(ID, "group_id")


def commune_stats_scan(spark, sf):
    path = _folder(spark, "communes")
    at = {v: k for k, v in src.lookups.COMMUNE_STATS_POSITIONS.items()}
    width = max(at) + 1
    body = commune_stats(spark, sf).select(
        *[
            (F.col(at[i]).cast("string") if i in at else F.lit(f"x{i}")).alias(f"c{i}")
            for i in range(width)
        ]
    )
    heads = spark.range(3).select(*[F.lit("heading").alias(f"c{i}") for i in range(width)])
    heads.union(body).write.csv(path)
    return src.read_commune_stats(spark, path).select(
        F.col("nis_code").cast("int"), F.col("year").cast("int"),
        F.col("house_count").cast("long"), "house_median",
        F.col("apt_count").cast("long"), "apt_median",
    )


def postal_map_scan(spark, sf):
    path = _folder(spark, "postal")
    out = (
        postal_map(spark, sf)
        .orderBy("ord", "postal_code")
        .select(
            F.col("nis_code").alias(src.lookups.POSTAL_MAP_COLUMNS["nis_code"]),
            F.lit("x").alias("Commune"),
            F.concat(F.lit(" "), "postal_code").alias(
                src.lookups.POSTAL_MAP_COLUMNS["postal_code"]
            ),
        )
    )
    out.write.option("header", True).option("sep", ";").csv(path)
    return src.read_postal_map(spark, path).select(
        "postal_code", F.col("nis_code").cast("int").alias("nis_code")
    )


# --- scalar functions and projections ----------------------------------------


def text_normalise(spark, sf):
    df = listings(spark, sf)
    return df.select(
        ID,
        fn.normalised(F.col("street")).alias("street"),
        fn.normalised(F.col("flooding_area_type")).alias("flooding"),
        fn.trimmed(F.col("epc")).alias("epc"),
    )


def number_parse(spark, sf):
    df = listings(spark, sf)
    return df.select(
        ID, *[fn.to_number(df, c).alias(c) for c in ("price", "indoor_parking", "floor")]
    )


def date_parse(spark, sf):
    df = listings(spark, sf)
    posted = fn.posted_at(df, "date_posted")
    return df.select(
        ID,
        F.to_date(posted).alias("posted"),
        F.year(posted).alias("y"),
        F.month(posted).alias("m"),
    )


def log_target(spark, sf):
    df = listings(spark, sf)
    price = fn.to_number(df, "price")
    usable = df.select(ID, price.alias("price")).filter("price > 0")
    labelled = usable.withColumn("label", training.log_label(usable))
    return training.back_to_euros("label").transform(labelled).select(
        ID, F.round("label", 9).alias("log_price"), F.round("predicted", 2).alias("price_back")
    )


def euros_text(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(
        "l_orderkey", "l_linenumber", fn.euros(F.col("l_extendedprice") * 100).alias("shown")
    )


def row_completeness(spark, sf):
    df = listings(spark, sf)
    return df.select(
        ID, fn.completeness(df, [c for c in df.columns if c != "row_ord"]).alias("filled")
    )


def drop_and_date_parts(spark, sf):
    return clean(listings(spark, sf), on_bad_date="null")


def target_and_features(spark, sf):
    df = listings(spark, sf).select(ID, "category", "price", "livable_surface")
    target, inputs = cols.target_and_features(df)
    return inputs.unionByName(target, allowMissingColumns=True)


# --- audit -------------------------------------------------------------------


def swap_coordinates(spark, sf):
    return coord.swap_coordinates(listings(spark, sf)).select(ID, "latitude", "longitude")


def _located(spark, sf):
    return coord.null_invalid_coordinates(coord.swap_coordinates(listings(spark, sf)))


def null_invalid_coordinates(spark, sf):
    return _located(spark, sf).select(ID, "latitude", "longitude")


def null_where_rules(spark, sf):
    return nulling.null_implausible(listings(spark, sf)).select(
        ID, "livable_surface", "garages", "facades", "number_of_floors", "floor"
    )


def null_floor_alone(spark, sf):
    return nulling.null_invalid_floor(listings(spark, sf)).select(ID, "floor")


def dedup_safe(spark, sf):
    return dedup.remove_safe_duplicates(_located(spark, sf))


def dedup_suspicious(spark, sf):
    return dedup.remove_suspicious_duplicates(listings(spark, sf))


def dedup_exact(spark, sf):
    return dedup.remove_exact_duplicates(
        listings(spark, sf).drop(*S.METADATA_COLUMNS, "row_ord")
    )


def first_per_key(spark, sf):
    return _postal(spark, sf)


def price_filter_p99(spark, sf):
    priced = prices.remove_invalid_price(listings(spark, sf))
    return priced.select(ID, "price")


def price_quantile(spark, sf):
    prices_ = listings(spark, sf).select("price")
    cap = exact_quantiles(prices_, ["price"], 0.99)["price"]
    return prices_.agg(F.count("*").alias("rows"), F.lit(cap).alias("p99"))


def price_quantile_narrowed(spark, sf):
    prices_ = listings(spark, sf).select("price")
    cap = exact_quantiles(prices_, ["price"], 0.99, ranked_at_once=100)["price"]
    return prices_.agg(F.count("*").alias("rows"), F.lit(cap).alias("p99"))


def price_cap_approx(spark, sf):
    """Whether the ranks of the approximate cap lie within its bound of the wanted rank."""
    df = listings(spark, sf)
    found = df.select(fn.to_number(df, "price").alias("price")).where("price IS NOT NULL")
    cap = prices.price_cap(df, approx=True)
    n, off = F.count("*"), F.count("*") / 10_000 + 1
    below, upto = F.count_if(F.col("price") < cap), F.count_if(F.col("price") <= cap)
    return found.agg(n.alias("rows"), ((below <= 0.99 * n + off) & (upto >= 0.99 * n - off)).alias("within"))


def audit_listings(spark, sf):
    return audit(listings(spark, sf)).listings


def audit_report(spark, sf):
    return audit(listings(spark, sf)).report


def audit_report_limits(spark, sf):
    return audit(listings(spark, sf), limits=S.Limits(min_price=200_000)).report


def lineitem_price_audit(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    priced = prices.remove_invalid_price(
        lines, "l_extendedprice", S.Limits(min_price=2000)
    )
    return nulling.null_where(priced, "l_quantity", F.col("l_quantity") < 12)


# --- features ----------------------------------------------------------------


def availability_flag(spark, sf):
    return features.availability_flag(listings(spark, sf)).select(ID, "available_immediately")


def category_scope(spark, sf):
    return features.category_scope(listings(spark, sf)).select(ID, "category")


def epc_quality(spark, sf):
    return features.epc_quality(listings(spark, sf)).select(ID, "epc_quality")


def flooding_area(spark, sf):
    return features.flooding_area(listings(spark, sf)).select(ID, "flooding_area_clean")


def parking_flags(spark, sf):
    return features.parking_flags(listings(spark, sf)).select(
        ID, "indoor_parking", "outdoor_parking"
    )


def building_state(spark, sf):
    return features.building_state(listings(spark, sf)).select(ID, "building_state")


def property_age(spark, sf):
    dated = cols.date_parts(listings(spark, sf), on_bad_date="null")
    return features.property_age(dated).select(ID, "property_age")


def commune_code(spark, sf):
    return add_commune_code(listings(spark, sf), _postal(spark, sf)).select(ID, "nis_code")


def _enriched(spark, sf):
    return enrich_with_commune_stats(
        listings(spark, sf), _postal(spark, sf), _stats(spark, sf)
    )


def commune_enrich(spark, sf):
    return _enriched(spark, sf).select(
        ID, "statbel_commune_median", "statbel_transaction_count"
    )


def commune_match_count(spark, sf):
    return count_enriched(_enriched(spark, sf))


def engineered(spark, sf):
    return engineer_features(
        clean(listings(spark, sf), on_bad_date="null"), _postal(spark, sf), _stats(spark, sf)
    )


def _clean_without_order(spark, sf):
    return clean(listings(spark, sf), on_bad_date="null").drop("row_ord")


def cv_table(spark, sf):
    return prepare_cv(
        _clean_without_order(spark, sf), _postal(spark, sf), _stats(spark, sf)
    ).drop(ROW_KEY)


def training_split_sizes(spark, sf):
    ready = prepare_training(
        _clean_without_order(spark, sf), _postal(spark, sf), _stats(spark, sf)
    )
    return ready.groupBy("split").agg(F.count("*").alias("rows"))


# --- split and encoders ------------------------------------------------------


def _split(spark, sf):
    return split_train_test(listings(spark, sf), ID)


def exact_split(spark, sf):
    return _split(spark, sf).select(ID, "split")


def encoder_folds(spark, sf):
    return listings(spark, sf).select(ID, fold_of(F.col(ID)).alias("fold"))


def median_impute(spark, sf):
    df = listings(spark, sf).select(ID, *NUMBERS)
    filled = encoders.MedianImputer(inputCols=list(NUMBERS)).fit(df).transform(df)
    return filled.select(ID, *[f"num_{c}" for c in NUMBERS])


def standardise(spark, sf):
    df = listings(spark, sf).select(ID, *NUMBERS)
    filled = encoders.MedianImputer(inputCols=list(NUMBERS)).fit(df).transform(df)
    names = [f"num_{c}" for c in NUMBERS]
    scaled = encoders.Standardizer(inputCols=names).fit(filled).transform(filled)
    return scaled.select(ID, *[F.round(f"std_{c}", 6).alias(f"std_{c}") for c in names])


def zero_fill(spark, sf):
    df = listings(spark, sf)
    names = S.FLAGS_MISSING_AS_ZERO
    return encoders.zero_fill(names).transform(df).select(ID, *[f"flag_{c}" for c in names])


def one_hot_long(spark, sf):
    df = encoders.unknown_fill(HOT).transform(listings(spark, sf).select(ID, *HOT))
    indexer, encoder = encoders.one_hot(HOT)
    fitted = indexer.fit(df)
    hot = encoder.fit(indexed := fitted.transform(df)).transform(indexed)
    tall = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.lit(list(labels)).alias("labels"),
                    vector_to_array(f"hot_{c}").alias("slots"),
                )
                for c, labels in zip(HOT, fitted.labelsArray)
            ]
        )
    )
    return (
        hot.select(ID, tall.alias("f"))
        .select(ID, "f.feature", "f.labels", F.posexplode("f.slots").alias("at", "value"))
        .filter("value <> 0")
        .select(ID, "feature", F.get("labels", F.col("at")).alias("category"), "value")
    )


def ordinal_rank(spark, sf):
    df = features.category_scope(features.epc_quality(features.building_state(listings(spark, sf))))
    return encoders.ordinal_rank(S.ORDINAL_FEATURES).transform(df).select(
        ID, *[f"ord_{c}{part}" for c in S.ORDINAL_FEATURES for part in ("", "_missing")]
    )


def _priced_postal(spark, sf):
    df = listings(spark, sf)
    price = fn.to_number(df, "price")
    return (
        df.select(ID, "postal_code", price.alias("price"))
        .filter(F.col("price") >= 30000)
        .select(
            ID,
            "postal_code",
            F.log1p("price").alias("label"),
            (F.col(ID) % 5).cast("int").alias("fold"),
        )
    )


def _encoder():
    return encoders.CrossFitTargetEncoder(inputCol="postal_code", outputCol="encoded")


def target_encode_oof(spark, sf):
    by_fold = _encoder().encodings_by_fold(_priced_postal(spark, sf))
    return by_fold.select(
        F.col("category").alias("postal_code"), "fold", F.round("encoding", 6).alias("encoded")
    )


def target_encode_training(spark, sf):
    _, encoded = _encoder().fit_training(_priced_postal(spark, sf))
    return encoded.select(ID, F.round("encoded", 6).alias("encoded"))


def target_encode_new(spark, sf):
    model = _encoder().fit(_priced_postal(spark, sf))
    # Every fourth postal code looks unseen to the model.
    code = F.when(
        F.col("postal_code").cast("int") % 4 == 0, F.concat(F.lit("9"), "postal_code")
    ).otherwise(F.col("postal_code"))
    new = listings(spark, sf).select(ID, code.alias("postal_code"))
    return model.transform(new).select(ID, F.round("encoded", 6).alias("encoded"))


# --- evaluation --------------------------------------------------------------


def _group_mean_predictions(spark, sf):
    """Each price predicted by the mean price of its category in the train rows."""
    df = prices.remove_invalid_price(listings(spark, sf))
    df = src.stage(
        df.select(ID, "price", F.coalesce("category", F.lit(S.UNKNOWN)).alias("category")),
        "priced",
    )
    df = split_train_test(df, ID)
    means = df.filter("split = 'train'").groupBy("category").agg(
        F.avg("price").alias("predicted")
    )
    return lookup_join(df, means, "category").select(
        ID, "split", F.col("price").alias("actual"), "predicted"
    )


def metrics_group_mean(spark, sf):
    return evaluate.rounded(evaluate.metrics(_group_mean_predictions(spark, sf)))


def overfit_gaps(spark, sf):
    gaps = evaluate.overfit_gaps(evaluate.metrics(_group_mean_predictions(spark, sf)))
    return gaps.select(
        F.round("mae_gap", 2).alias("mae_gap"),
        F.round("rmse_gap", 2).alias("rmse_gap"),
        F.round("r2_gap", 4).alias("r2_gap"),
    )


def prediction_range(spark, sf):
    test = _group_mean_predictions(spark, sf).filter("split = 'test'")
    spread = evaluate.prediction_range(test)
    return spread.select(
        F.round("min_predicted", 2).alias("min_predicted"),
        F.round("max_predicted", 2).alias("max_predicted"),
        "negative_predictions",
    )


def worst_errors(spark, sf):
    test = _group_mean_predictions(spark, sf).filter("split = 'test'")
    worst = evaluate.worst_errors(test, ID)
    shown = ("actual", "predicted", "error", "absolute_error")
    return worst.select(ID, *[fn.euros(F.col(c)).alias(c) for c in shown])


# --- models ------------------------------------------------------------------


def ols_one_feature(spark, sf):
    df = listings(spark, sf)
    rows = df.select(
        ID, fn.to_number(df, "price").alias("price"), "livable_surface"
    ).filter("price >= 30000 AND livable_surface IS NOT NULL")
    rows = VectorAssembler(inputCols=["livable_surface"], outputCol="features").transform(
        rows.withColumn("label", F.log1p("price"))
    )
    model = linear_regression().fit(rows)
    return model.transform(rows).select(ID, F.round("prediction", 6).alias("prediction"))


_ready: dict[tuple[str, str], DataFrame] = {}


def prepared(spark, sf):
    """Audited, cleaned and engineered listings with their split, made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ready:
        audited = audit(listings(spark, sf)).listings
        _ready[key] = prepare_training(
            clean(audited, on_bad_date="null").drop("row_ord"), _postal(spark, sf), _stats(spark, sf)
        )
    return _ready[key]


def linear_predict(spark, sf):
    return training.train(prepared(spark, sf), "linear").predictions


def rf_predict(spark, sf):
    return training.train(prepared(spark, sf), "random_forest", numTrees=20, maxDepth=8).predictions


def gbt_predict(spark, sf):
    return training.train(prepared(spark, sf), "boosted_trees").predictions


def gbt_metrics(spark, sf):
    return training.train(prepared(spark, sf), "boosted_trees", maxIter=10, stepSize=0.2).metrics


def model_roundtrip(spark, sf):
    """Rows by split, and the share that a saved and loaded model predicts alike."""
    ready = prepared(spark, sf)
    result = training.train(ready, "random_forest", numTrees=10, maxDepth=6)
    path = _folder(spark, "model")
    training.save_model(result.model, path)
    again = evaluate.score(training.load_model(path), ready).select(
        ROW_KEY, F.col("predicted").alias("reloaded")
    )
    same = (F.abs(F.col("predicted") - F.col("reloaded")) < 1e-6).cast("double")
    return result.predictions.join(again, ROW_KEY).groupBy("split").agg(
        F.count("*").alias("rows"), F.avg(same).alias("same")
    )


def _cells(spark, sf, kind, flags, **settings):
    """All rows with a price, through the whole training, on a few flags."""
    df = listings(spark, sf).select(ID, "price", *flags)
    ready = split_train_test(src.stage(prices.remove_invalid_price(df), "cells"), ID)
    groups = training.FeatureGroups((), flags, (), (), (), {})
    return training.train(ready, kind, groups, key=ID, **settings)


FLAGS = ("heat_pump", "garden", "alarm")
WHOLE = {"featureSubsetStrategy": "all", "maxDepth": 3, "minInstancesPerNode": 1}


def _predicted(trained):
    return trained.predictions.withColumn("predicted", F.round("predicted", 3))


def linear_cells(spark, sf):
    predictions = _cells(spark, sf, "linear", FLAGS[:2]).predictions
    return predictions.select(
        ID, "split", "actual", F.round(F.log1p("predicted"), 6).alias("predicted_log")
    )


def linear_collinear(spark, sf):
    """Least squares on a category and a coarser one, all values of both: many solutions, one prediction."""
    df = listings(spark, sf)
    kind = F.when(F.col("category").isin("house", "appartment"), "home").otherwise(F.col("category"))
    df = prices.remove_invalid_price(df.select(ID, "price", "category", kind.alias("kind")))
    ready = split_train_test(src.stage(df, "cells"), ID)
    groups = training.FeatureGroups((), (), (), ("category", "kind"), (), {})
    predictions = training.train(ready, "linear", groups, key=ID).predictions
    return predictions.select(ID, "split", "actual", F.round(F.log1p("predicted"), 6).alias("predicted_log"))


def cross_validated_cells(spark, sf):
    """Errors per fold of trees grown to every cell of three flags, each fold by the other four."""
    df = prices.remove_invalid_price(listings(spark, sf).select(ID, "price", *FLAGS))
    groups = training.FeatureGroups((), FLAGS, (), (), (), {})
    done = training.cross_validate(df, "random_forest", groups, key=ID, numTrees=1, bootstrap=False, **WHOLE)
    return evaluate.rounded(done.by_fold)


def forest_cells(spark, sf):
    return _predicted(_cells(spark, sf, "random_forest", FLAGS, numTrees=1, bootstrap=False, **WHOLE))


def _boosted(spark, sf):
    return _cells(spark, sf, "boosted_trees", FLAGS, maxIter=3, subsamplingRate=1.0, **WHOLE)


def boosted_cells(spark, sf):
    return _predicted(_boosted(spark, sf))


def boosted_cells_metrics(spark, sf):
    return evaluate.rounded(_boosted(spark, sf).metrics)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        listings_csv_scan, audited_table_roundtrip, commune_stats_scan, postal_map_scan,
        text_normalise, number_parse, date_parse, log_target, euros_text, row_completeness,
        drop_and_date_parts, target_and_features, swap_coordinates, null_invalid_coordinates,
        null_where_rules, null_floor_alone, dedup_safe, dedup_suspicious, dedup_exact,
        first_per_key, price_filter_p99, price_quantile, audit_listings, audit_report,
        lineitem_price_audit, availability_flag, category_scope, epc_quality, flooding_area,
        parking_flags, building_state, property_age, commune_code, commune_enrich,
        commune_match_count, engineered, cv_table, training_split_sizes, exact_split,
        encoder_folds, median_impute, standardise, zero_fill, one_hot_long, ordinal_rank,
        target_encode_oof, target_encode_training, target_encode_new, metrics_group_mean,
        overfit_gaps, prediction_range, worst_errors, ols_one_feature, linear_predict,
        rf_predict, gbt_predict, gbt_metrics, model_roundtrip, linear_cells, forest_cells,
        boosted_cells, boosted_cells_metrics, audit_report_limits, price_quantile_narrowed,
        price_cap_approx, cross_validated_cells, listings_in_order, listings_csv_line_breaks, group_numbers, linear_collinear,
    )
}
