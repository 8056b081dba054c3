"""All registered queries and their SQL counterparts."""

from . import (  # noqa: F401
    catalog_drift,
    catalog_evaluation,
    catalog_features,
    catalog_models,
    catalog_profile,
    catalog_runs,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
