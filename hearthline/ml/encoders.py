"""Imputing, scaling, one-hot, ordinal and target encoding.

What is a fixed expression per row after fitting becomes Spark's own ``SQLTransformer``, so
it runs as generated code and saves and loads like any built-in stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions import number_sql, to_number
from hearthline.operators.lookup_join import lookup_join
from hearthline.operators.quantiles import exact_quantiles
from hearthline.settings import UNKNOWN
from hearthline.sources.stages import stage


def add_columns(expressions: Mapping[str, str]) -> SQLTransformer:
    """A stage that adds columns given as SQL expressions."""
    listed = ", ".join(f"{sql} AS `{name}`" for name, sql in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")


def _double(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --- numeric columns ---------------------------------------------------------


class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing numbers with the exact median of the fitted rows.

    Fitted columns appear as ``num_<column>``; a column without any value has no median and
    is left out.
    """

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        medians = exact_quantiles(dataset, self.getInputCols(), 0.5)
        return add_columns(
            {
                f"num_{c}": f"coalesce({number_sql(c)}, {_double(m)})"
                for c, m in medians.items()
                if m is not None
            }
        )


class Standardizer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Centre and scale by the population deviation into ``std_<column>``.

    A constant column is centred only.
    """

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        names = self.getInputCols()
        moments = dataset.agg(
            *[F.avg(to_number(dataset, c)).alias(f"{c}|mean") for c in names],
            *[F.stddev_pop(to_number(dataset, c)).alias(f"{c}|std") for c in names],
        ).first()
        return add_columns(
            {
                f"std_{c}": f"(`{c}` - {_double(moments[f'{c}|mean'])})"
                f" / {_double(moments[f'{c}|std'] or 1.0)}"
                for c in names
                if moments[f"{c}|mean"] is not None
            }
        )


def output_columns(stage: SQLTransformer, prefix: str, inputs: Sequence[str]) -> list[str]:
    """Which ``<prefix><column>`` columns a fitted stage adds, in input order."""
    made = stage.getStatement()
    return [f"{prefix}{c}" for c in inputs if f"AS `{prefix}{c}`" in made]


# --- flags, categories and ranks ---------------------------------------------


def zero_fill(columns: Sequence[str]) -> SQLTransformer:
    """``flag_<column>``: a missing flag is 0."""
    return add_columns(
        {f"flag_{c}": f"coalesce({number_sql(c)}, 0D)" for c in columns}
    )


def unknown_fill(columns: Sequence[str]) -> SQLTransformer:
    """``cat_<column>``: the value as text, a missing one as "Unknown"."""
    return add_columns(
        {f"cat_{c}": f"coalesce(CAST(`{c}` AS STRING), {_text(UNKNOWN)})" for c in columns}
    )


MAX_CATEGORIES = 10_000


def check_categories(df: DataFrame, columns: Sequence[str], most: int = MAX_CATEGORIES) -> None:
    """Fail if a ``cat_<column>`` has clearly more than ``most`` values.

    Fitted categories are kept on the driver and each is a slot of the vector, so free text that got
    into a category column is refused here and not found out by a full driver.
    """
    counts = df.agg(*[F.approx_count_distinct(f"cat_{c}", 0.02).alias(c) for c in columns]).first()
    wide = {c: counts[c] for c in columns if counts[c] > most * 1.05}
    if wide:
        raise ValueError(f"more than {most} categories: {wide}; leave the column out or encode its target")


def one_hot(columns: Sequence[str]) -> list[Estimator]:
    """Stages from ``cat_<column>`` to ``hot_<column>``, one slot per fitted category.

    The indexer keeps one extra index for unseen text and the encoder drops that last slot, so
    every fitted category has a slot and unseen text is all zeros.
    """
    indexer = StringIndexer(
        inputCols=[f"cat_{c}" for c in columns],
        outputCols=[f"idx_{c}" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"idx_{c}" for c in columns],
        outputCols=[f"hot_{c}" for c in columns],
        dropLast=True,
    )
    return [indexer, encoder]


def ordinal_rank(scales: Mapping[str, Sequence[str]]) -> SQLTransformer:
    """``ord_<column>``: place on the scale, -1 when missing or unlisted.

    Spark's trees take no missing input, so ``ord_<column>_missing`` marks those rows.
    """
    made = {}
    for c, scale in scales.items():
        whens = " ".join(f"WHEN {_text(v)} THEN {float(i)}D" for i, v in enumerate(scale))
        known = ", ".join(_text(v) for v in scale)
        made[f"ord_{c}"] = f"CASE `{c}` {whens} ELSE -1D END"
        made[f"ord_{c}_missing"] = f"CASE WHEN `{c}` IN ({known}) THEN 0D ELSE 1D END"
    return add_columns(made)


# --- target encoding ---------------------------------------------------------


class _TargetEncoderParams(HasInputCol, HasOutputCol):
    labelCol = Param(Params._dummy(), "labelCol", "target", TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "fold number", TypeConverters.toString)

    def getLabelCol(self) -> str:
        return self.getOrDefault(self.labelCol)

    def getFoldCol(self) -> str:
        return self.getOrDefault(self.foldCol)


def _blend(n, s, q, mean, variance):
    """Shrink a category mean towards the overall mean.

    ``s`` and ``q`` are sums of the target and its square, centred near the overall mean, so
    that the variance does not lose its digits.
    """
    own = s / n
    spread = F.greatest(q / n - own * own, F.lit(0.0))
    weight = F.try_divide(variance * n, variance * n + spread)
    return F.when(
        n.isNull() | (n == 0) | weight.isNull(), mean
    ).otherwise(weight * own + (1 - weight) * mean)


class CrossFitTargetEncoder(
    Estimator, _TargetEncoderParams, DefaultParamsReadable, DefaultParamsWritable
):
    """Category to smoothed mean target, with empirical Bayes weights.

    ``fit`` encodes from all rows, for rows not fitted on. ``fit_training`` also encodes the
    fitted rows, each from the other folds only, so that a row's own target does not leak.
    Both come from one grouped pass; everything after it works on (category, fold) totals.
    """

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol="label", foldCol="fold"):
        super().__init__()
        self._setDefault(labelCol="label", foldCol="fold")
        self._set(**self._input_kwargs)

    def _totals(self, dataset: DataFrame) -> tuple[DataFrame, float]:
        label = F.col(self.getLabelCol())
        centre = dataset.agg(F.avg(label)).first()[0]
        if centre is None:
            raise ValueError("no rows to fit")
        off = label - F.lit(centre)
        totals = dataset.groupBy(
            F.col(self.getInputCol()).alias("category"), F.col(self.getFoldCol()).alias("fold")
        ).agg(
            F.count(label).cast("double").alias("n"),
            F.sum(off).alias("s"),
            F.sum(off * off).alias("q"),
        )
        # Stored: the fit reads these few rows several times and the data once.
        return stage(totals, "target_totals"), centre

    def _fit(self, dataset: DataFrame) -> CrossFitTargetEncoderModel:
        totals, centre = self._totals(dataset)
        return self._model(totals, centre)

    def _model(self, totals: DataFrame, centre: float) -> CrossFitTargetEncoderModel:
        n, s, q = totals.agg(F.sum("n"), F.sum("s"), F.sum("q")).first()
        mean, variance = s / n, max(q / n - (s / n) ** 2, 0.0)
        by_category = totals.groupBy("category").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")
        )
        value = _blend(F.col("n"), F.col("s"), F.col("q"), F.lit(mean), F.lit(variance))
        table = by_category.select("category", (value + F.lit(centre)).alias("encoding"))
        model = CrossFitTargetEncoderModel(table, mean + centre)
        return self._copyValues(model)

    def encodings_by_fold(self, dataset: DataFrame) -> DataFrame:
        """(category, fold, encoding) where the encoding leaves that fold out."""
        totals, centre = self._totals(dataset)
        return self._by_fold(totals, centre)

    def _by_fold(self, totals: DataFrame, centre: float) -> DataFrame:
        per_fold = totals.groupBy("fold").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")
        )
        folds = {r["fold"]: (r["n"], r["s"], r["q"]) for r in per_fold.collect()}  # few folds
        whole = [sum(part) for part in zip(*folds.values())]
        means, variances = [], []
        for fold, part in folds.items():
            n, s, q = (w - p for w, p in zip(whole, part))
            mean = s / n if n else whole[1] / whole[0]
            variance = max(q / n - mean * mean, 0.0) if n else 0.0
            means += [F.lit(fold), F.lit(mean)]
            variances += [F.lit(fold), F.lit(variance)]
        category = Window.partitionBy("category")
        others = {c: F.sum(c).over(category) - F.col(c) for c in ("n", "s", "q")}
        rest = totals.select("category", "fold", *[v.alias(c) for c, v in others.items()])
        value = _blend(
            F.when(F.col("n") > 0.5, F.col("n")),
            F.col("s"),
            F.col("q"),
            F.create_map(*means)[F.col("fold")],
            F.create_map(*variances)[F.col("fold")],
        )
        return rest.select("category", "fold", (value + F.lit(centre)).alias("encoding"))

    def fit_training(self, dataset: DataFrame) -> tuple[CrossFitTargetEncoderModel, DataFrame]:
        """The model for new rows, and the fitted rows with their out-of-fold encoding."""
        totals, centre = self._totals(dataset)
        by_fold = self._by_fold(totals, centre).select(
            F.col("category").alias(self.getInputCol()),
            F.col("fold").alias(self.getFoldCol()),
            F.col("encoding").alias(self.getOutputCol()),
        )
        encoded = lookup_join(dataset, by_fold, [self.getInputCol(), self.getFoldCol()])
        return self._model(totals, centre), encoded


class CrossFitTargetEncoderModel(Model, _TargetEncoderParams, MLReadable, MLWritable):
    """Encodings as a table; unseen categories get the overall mean."""

    def __init__(self, table: DataFrame | None = None, mean: float | None = None):
        super().__init__()
        self._setDefault(labelCol="label", foldCol="fold")
        self.table = table
        self.mean = mean

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        table = self.table.select(
            F.col("category").alias("_category"), F.col("encoding").alias("_encoding")
        )
        keyed = dataset.withColumn("_category", F.col(self.getInputCol()))
        encoded = F.coalesce(F.col("_encoding"), F.lit(self.mean))
        return (
            lookup_join(keyed, table, "_category")
            .withColumn(out, encoded)
            .drop("_category", "_encoding")
        )

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, model: CrossFitTargetEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(
            self.model, path, self.sparkSession, extraMetadata={"mean": self.model.mean}
        )
        self.model.table.write.parquet(f"{path}/encodings")


class _EncoderReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CrossFitTargetEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        table = self.sparkSession.read.parquet(f"{path}/encodings")
        model = self.cls(table, metadata["mean"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model

