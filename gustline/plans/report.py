"""All report tables of one filter selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import contract as K
from ..operators import reports as R
from ..operators.clean import with_absent_columns
from ..operators.joins import with_location
from ..operators.learning import cluster_profile, fit_clusters
from ..session import stage

GUARDED = (K.LOSS, K.BREACH, K.SCORE, K.TIER, K.LABEL, K.EVENT_COUNT, K.TOTAL_DAMAGE, K.HUMAN_IMPACT)


def prepare(features: DataFrame) -> DataFrame:
    """Add absent report columns as 0 and the map position of every utility."""
    return with_location(with_absent_columns(features, GUARDED), jitter_by=[K.KEY])


def report_tables(
    features: DataFrame,
    state: str = R.ALL_STATES,
    ownership: str = R.ALL_TYPES,
    region: str = R.ALL_REGIONS,
    tiers: Sequence[str] = (),
    metric: str = "saidi",
    clusters: int = 6,
) -> dict[str, DataFrame]:
    """Every table of the report for one selection of the stored utility table.

    The selection is filtered once and stored; one scan of it gives a small cube, and all
    tables that add up come from that. The others scan their own columns of the selection. The
    utility table itself is read for the filter's fallback, the selection and the overall mean.
    A table without any utility gives tables without rows, but for the headline rows.
    """
    table = prepare(features)
    chosen = stage(R.filtered(table, state, ownership, region, tiers), "selection")
    cube = R.Cube(chosen)
    if cube.by().filter("utilities > 0").isEmpty():
        clustered = chosen.withColumn("cluster", F.lit(0))
    else:
        clustered, _ = fit_clusters(chosen, clusters)
    return {
        "kpi": R.kpi_row(cube, table),
        "findings": R.top_findings(cube),
        "state_metric": R.state_metric(cube, metric),
        "locations": chosen.select(
            K.ident(K.KEY), K.ident(K.NAME), K.STATE, K.TIER, K.SAIDI, K.OWNERSHIP,
            K.EVENT_COUNT, "lat", "lon",
        ),
        "clusters": cluster_profile(clustered),
        "tier_mix": R.tier_mix(cube),
        "tier_by_ownership": R.tier_by_ownership(cube),
        "tier_quantiles": R.tier_quantiles(chosen),
        "score_histogram": R.score_histogram(chosen),
        "region_heat": R.region_heat(cube),
        "region_radar": R.region_radar(cube),
        "bubbles": R.bubble_points(chosen),
        "top_states": R.top_states(cube),
        "top_loss": R.top_loss(chosen),
        "ranking": R.ranking_table(chosen),
    }
