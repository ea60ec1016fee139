"""The steps put together: audit, clean, prepare, train, score."""

from hearthline.plans.audit import Audit, audit
from hearthline.plans.clean import clean
from hearthline.plans.prepare import engineer_features, prepare_cv, prepare_training

__all__ = [
    "Audit", "audit", "clean", "engineer_features", "prepare_cv", "prepare_training",
]
