"""Rank-based risk score, tiers, economic columns and labels on the utility table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import contract as K
from ..functions import scalars as S
from ..session import stage
from .ranking import quantile_array, with_percent_rank


def risk_tier(score: Column, high: Column, medium: Column) -> Column:
    return F.when(score >= high, K.HIGH).when(score >= medium, K.MEDIUM).otherwise(K.LOW)


def with_rank_scores(utilities: DataFrame, saidi: str = K.SAIDI, saifi: str = K.SAIFI,
                     key: str = K.KEY) -> DataFrame:
    """Percentile ranks of both reliability metrics and their mean as ``risk_score``."""
    wanted = {K.SAIDI_RANK: saidi, K.SAIFI_RANK: saifi}
    ranks = {out: c for out, c in wanted.items() if c in utilities.columns}
    if not ranks:
        return utilities
    ranked = with_percent_rank(utilities, ranks, [key])
    if len(ranks) < 2:
        return ranked
    score = (F.col(K.SAIDI_RANK) + F.col(K.SAIFI_RANK)) / F.lit(2.0)
    return ranked.withColumn(K.SCORE, score)


def with_tiers_and_label(scored: DataFrame) -> DataFrame:
    """Tier from the 80% and 50% quantiles of the score; label 1 for the High tier.

    ``scored`` is read again for the quantiles: pass a stored or staged table.
    """
    cut = quantile_array(scored, K.SCORE, [K.HIGH_QUANTILE, K.MEDIUM_QUANTILE])
    score, high = F.col(K.SCORE), F.col("_cut")[0]
    return (
        scored.withColumn("_cut", cut)
        .withColumn(K.TIER, risk_tier(score, high, F.col("_cut")[1]))
        .withColumn(K.LABEL, (score >= high).cast("int"))
        .drop("_cut")
    )


def economic_columns(have: set[str]) -> dict[str, Column]:
    """Loss, breach flag and margin, log damage and human impact from what is present."""
    out: dict[str, Column] = {}
    if K.SAIDI not in have:
        return out
    saidi = F.col(K.SAIDI)
    counties = F.coalesce(F.col(K.COUNTIES), F.lit(1.0)) if K.COUNTIES in have else F.lit(1.0)
    loss = (
        saidi / F.lit(60.0)
        * F.greatest(counties, F.lit(1.0))
        * F.lit(K.CUSTOMERS_PER_COUNTY)
        * F.lit(K.USD_PER_CUSTOMER_HOUR)
    )
    out[K.LOSS] = S.half_even(loss)
    out[K.BREACH] = F.coalesce(saidi > K.SLA_MINUTES, F.lit(False)).cast("int")
    out[K.MARGIN] = S.half_even(saidi - K.SLA_MINUTES, 1)
    if K.TOTAL_DAMAGE in have:
        out[K.LOG_DAMAGE] = F.log1p(F.coalesce(K.TOTAL_DAMAGE, F.lit(0.0)))
    injuries, deaths = K.HARM[0], K.HARM[2]
    if {injuries, deaths} <= have:
        out[K.HUMAN_IMPACT] = F.coalesce(injuries, F.lit(0.0)) + F.lit(
            K.DEATH_WEIGHT
        ) * F.coalesce(deaths, F.lit(0.0))
    return out


def with_economic_impact(utilities: DataFrame) -> DataFrame:
    return utilities.withColumns(economic_columns(set(utilities.columns)))


def risk_features(rollup: DataFrame) -> DataFrame:
    """Scores, economics, tiers and label on a stored roll-up, in the Gold column order."""
    scored = with_economic_impact(with_rank_scores(rollup))
    if K.SCORE not in scored.columns:
        return scored
    labelled = with_tiers_and_label(stage(scored, "scored"))
    order = [*rollup.columns, K.SAIDI_RANK, K.SAIFI_RANK, K.SCORE, K.TIER]
    rest = [c for c in labelled.columns if c not in order]
    return labelled.select(*[K.ident(c) for c in (*order, *rest)])


def relabelled(features: DataFrame, top_share: float, score: str = K.SCORE) -> DataFrame:
    """Label 1 for rows at or above the ``1 - top_share`` quantile of the score."""
    cut = quantile_array(features, score, [1 - top_share])
    return features.withColumn("label", (F.col(score) >= cut[0]).cast("int"))

