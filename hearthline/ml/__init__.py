"""Feature encoding, price models and their evaluation on ``pyspark.ml``."""

from hearthline.ml.encoders import (
    CrossFitTargetEncoder,
    CrossFitTargetEncoderModel,
    MedianImputer,
    Standardizer,
)
from hearthline.ml.evaluate import (
    metrics,
    overfit_gaps,
    prediction_range,
    score,
    worst_errors,
)
from hearthline.ml.models import (
    FULL_DEPTH,
    boosted_trees,
    linear_regression,
    random_forest,
)
from hearthline.ml.training import cross_validate, fit_price_model, load_model, save_model, train

__all__ = [
    "FULL_DEPTH", "CrossFitTargetEncoder", "CrossFitTargetEncoderModel", "MedianImputer", "Standardizer",
    "boosted_trees", "cross_validate", "fit_price_model", "linear_regression", "load_model", "metrics",
    "overfit_gaps", "prediction_range", "random_forest", "save_model", "score", "train",
    "worst_errors",
]
