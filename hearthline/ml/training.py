"""Fit a price model on log prices, evaluate it, keep it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import settings as S
from hearthline.functions import to_number
from hearthline.ml.encoders import (
    MAX_CATEGORIES,
    CrossFitTargetEncoder,
    MedianImputer,
    Standardizer,
    add_columns,
    check_categories,
    one_hot,
    ordinal_rank,
    output_columns,
    unknown_fill,
    zero_fill,
)
from hearthline.ml.evaluate import metrics, overfit_gaps, prediction_range, score, worst_errors
from hearthline.ml.models import REGRESSORS
from hearthline.operators.split import fold_of
from hearthline.plans.prepare import ROW_KEY
from hearthline.sources.stages import shared_folder, stage


@dataclass(frozen=True)
class FeatureGroups:
    """Which column is encoded how; every other column stays out of the model."""

    numeric: Sequence[str] = S.NUMERIC_FEATURES
    flags_zero: Sequence[str] = S.FLAGS_MISSING_AS_ZERO
    flags_unknown: Sequence[str] = S.FLAGS_MISSING_AS_UNKNOWN
    nominal: Sequence[str] = S.NOMINAL_FEATURES
    target_encoded: Sequence[str] = S.TARGET_ENCODED_FEATURES
    ordinal: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(S.ORDINAL_FEATURES))

    def columns(self) -> list[str]:
        return [
            *self.numeric, *self.flags_zero, *self.flags_unknown, *self.nominal,
            *self.target_encoded, *self.ordinal,
        ]

    def only(self, names: Sequence[str]) -> FeatureGroups:
        """The same groups without the columns that a table does not have."""
        have = set(names)

        def pick(group):
            return tuple(c for c in group if c in have)

        return FeatureGroups(
            pick(self.numeric), pick(self.flags_zero), pick(self.flags_unknown),
            pick(self.nominal), pick(self.target_encoded),
            {c: v for c, v in self.ordinal.items() if c in have},
        )


def log_label(df: DataFrame, target: str = S.TARGET) -> Column:
    """What models are fitted to: the log of one more than the price."""
    return F.log1p(to_number(df, target))


def back_to_euros(prediction: str) -> SQLTransformer:
    """The last stage of every model: column ``predicted`` from a prediction of the label."""
    return add_columns({"predicted": f"expm1(`{prediction}`)"})


def fit_price_model(
    train_rows: DataFrame,
    regressor: Estimator,
    groups: FeatureGroups | None = None,
    scale_numbers: bool = False,
    ordinal_as_categories: bool = False,
    key: str = ROW_KEY,
    target: str = S.TARGET,
    max_categories: int = MAX_CATEGORIES,
) -> PipelineModel:
    """Fit encoders and regressor on the log of the price.

    Not a plain ``Pipeline.fit``: the regressor must see out-of-fold target encodings, while
    the kept model encodes from all training rows. The model ends by turning its prediction
    back into euros, column ``predicted``.
    """
    groups = groups or FeatureGroups()
    df = train_rows.select(
        *groups.columns(),
        log_label(train_rows, target).alias("label"),
        fold_of(F.col(key)).alias("fold"),
    )
    shared_folder(df.sparkSession)  # boosted trees cut their lineage there
    fitted, inputs = [], []

    def add(stage_):
        nonlocal df
        model = stage_.fit(df) if isinstance(stage_, Estimator) else stage_
        df = model.transform(df)
        fitted.append(model)
        return model

    if groups.numeric:
        imputer = add(MedianImputer(inputCols=list(groups.numeric)))
        numbers = output_columns(imputer, "num_", groups.numeric)
        if scale_numbers and numbers:
            add(Standardizer(inputCols=numbers))
            numbers = [f"std_{c}" for c in numbers]
        inputs += numbers
    if groups.flags_zero:
        add(zero_fill(groups.flags_zero))
        inputs += [f"flag_{c}" for c in groups.flags_zero]
    categories = [*groups.flags_unknown, *groups.nominal]
    ranked = {} if ordinal_as_categories else dict(groups.ordinal)
    trailing = list(groups.ordinal) if ordinal_as_categories else []
    texts = [*categories, *groups.target_encoded, *trailing]
    if texts:
        add(unknown_fill(texts))
    if categories or trailing:
        check_categories(df, [*categories, *trailing], max_categories)
        for stage_ in one_hot([*categories, *trailing]):
            add(stage_)
    inputs += [f"hot_{c}" for c in categories]
    for c in groups.target_encoded:
        encoder = CrossFitTargetEncoder(inputCol=f"cat_{c}", outputCol=f"enc_{c}")
        model, df = encoder.fit_training(df)
        # Stored: the table of a few rows should not be grouped anew at every scoring.
        model.table = stage(model.table, "encodings")
        fitted.append(model)
        inputs.append(f"enc_{c}")
    inputs += [f"hot_{c}" for c in trailing]
    if ranked:
        add(ordinal_rank(ranked))
        inputs += [f"ord_{c}{part}" for c in ranked for part in ("", "_missing")]
    add(VectorAssembler(inputCols=inputs, outputCol="features"))

    ready = stage(df.select("features", "label"), "training")
    fitted.append(regressor.fit(ready))
    fitted.append(back_to_euros(regressor.getPredictionCol()))
    return PipelineModel(fitted)


@dataclass(frozen=True)
class Trained:
    """A fitted model with its evaluation tables."""

    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    gaps: DataFrame
    test_range: DataFrame
    worst: DataFrame


def train(
    prepared: DataFrame,
    kind: str = "boosted_trees",
    groups: FeatureGroups | None = None,
    key: str = ROW_KEY,
    **overrides,
) -> Trained:
    """Fit one kind of model on the train rows, predict both splits, evaluate.

    ``kind`` is "linear", "random_forest" or "boosted_trees"; ``overrides`` go to it.
    """
    linear = kind == "linear"
    model = fit_price_model(
        prepared.filter("split = 'train'"),
        REGRESSORS[kind](**overrides),
        groups,
        scale_numbers=linear,
        ordinal_as_categories=linear,
        key=key,
    )
    scored = score(model, prepared).select(
        key, "split", to_number(prepared, S.TARGET).alias("actual"), "predicted"
    )
    predictions = stage(scored, "predictions")
    by_split = metrics(predictions)
    test = predictions.filter("split = 'test'")
    return Trained(
        model,
        predictions,
        by_split,
        overfit_gaps(by_split),
        prediction_range(test),
        worst_errors(test, key),
    )


@dataclass(frozen=True)
class CrossValidated:
    """Predictions of each row by the model that did not see its fold, and the errors per fold."""

    predictions: DataFrame
    by_fold: DataFrame

    @property
    def summary(self) -> DataFrame:
        """Mean and spread of each measure over the folds, one row."""
        measures = ("mae", "rmse", "r2")
        return self.by_fold.agg(
            *[f(m).alias(f"{m}_{n}") for m in measures for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
        )


def cross_validate(
    rows: DataFrame,
    kind: str = "boosted_trees",
    groups: FeatureGroups | None = None,
    key: str = ROW_KEY,
    folds: int = S.CV_FOLDS,
    fold_col: str | None = None,
    **overrides,
) -> CrossValidated:
    """Fit one kind of model per fold, encoders included, on all other folds, and score it on its own.

    Takes the table of ``prepare_cv``. ``fold_col`` names given folds (a few whole numbers; rows without one take no part);
    else a seeded hash of ``key`` deals rows into ``folds``, apart from the folds of the target encoder.
    The columns that the model reads are stored once, and each fold's predictions.
    """
    groups = groups or FeatureGroups()
    linear = kind == "linear"
    fold = F.col(fold_col) if fold_col else fold_of(F.col(key), folds, S.SEED + 1)
    own = dict.fromkeys([key, S.TARGET, *groups.columns()])
    stored = stage(rows.select(*own, fold.cast("int").alias("cv_fold")), "cross-validation")
    numbers = sorted(r[0] for r in stored.where("cv_fold IS NOT NULL").select("cv_fold").distinct().collect())
    if len(numbers) < 2:
        raise ValueError("cross-validation needs rows in two folds at least")
    parts = []
    for k in numbers:
        model = fit_price_model(
            stored.where(F.col("cv_fold") != k), REGRESSORS[kind](**overrides), groups,
            scale_numbers=linear, ordinal_as_categories=linear, key=key,
        )
        scored = score(model, stored.where(F.col("cv_fold") == k)).select(
            key, F.col("cv_fold").alias("fold"), to_number(stored, S.TARGET).alias("actual"), "predicted"
        )
        parts.append(stage(scored, "fold-predictions"))
    predictions = reduce(DataFrame.unionByName, parts)
    return CrossValidated(predictions, metrics(predictions, by="fold"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
