"""Silver events to the Gold utility table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.risk import risk_features
from ..operators.rollup import utility_rollup
from ..session import stage


def build_features(silver: DataFrame, flag_mode: str = "numeric") -> DataFrame:
    """Roll up, rank, score, label.

    The roll-up is the only pass over the events; it is stored once because the ranks,
    quantiles and the table itself all read it.
    """
    return risk_features(stage(utility_rollup(silver, flag_mode), "rollup"))
