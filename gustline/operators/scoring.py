"""Batch scoring of utilities with a fitted pipeline."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from .. import contract as K
from ..functions import scalars as S
from .learning import positive_probability

# --- fixed values: request defaults
REQUEST_DEFAULTS = {
    "INJURIES_DIRECT": 0.0,
    "DEATHS_DIRECT": 0.0,
    "MAGNITUDE": 0.0,
    "months_with_events": 0.0,
    "County_Count": 1.0,
}
DEFAULT_OWNERSHIP, DEFAULT_REGION = "Cooperative", "SERC"
CROPS_SHARE = 0.1
INDIRECT_SHARE = 0.5


def derive_scoring_features(requests: DataFrame) -> DataFrame:
    """Model inputs from scoring requests; required: event count and total damage.

    Follows the serving rules, which differ from the roll-up: property damage is the
    whole total, crops a tenth of it, indirect harm half of direct harm, CAISO is 0, and
    any log damage or impact score sent along is recomputed.
    """
    have = set(requests.columns)

    def given(name: str, default: object):
        return F.coalesce(F.col(K.ident(name)), F.lit(default)) if name in have else F.lit(default)

    injuries, deaths = given("INJURIES_DIRECT", 0.0), given("DEATHS_DIRECT", 0.0)
    damage = F.col(K.TOTAL_DAMAGE)
    request_flags = [f for f in K.GOLD_FLAGS if f != "CAISO"]
    region_source = "NERC_Region" if "NERC_Region" in have else K.REGION
    derived = {
        "total_property_damage_usd": damage,
        "total_crops_damage_usd": damage * F.lit(CROPS_SHARE),
        K.LOG_DAMAGE: F.log1p(damage),
        "INJURIES_DIRECT": injuries,
        "INJURIES_INDIRECT": injuries * F.lit(INDIRECT_SHARE),
        "DEATHS_DIRECT": deaths,
        "DEATHS_INDIRECT": deaths * F.lit(INDIRECT_SHARE),
        K.HUMAN_IMPACT: injuries + deaths * F.lit(K.DEATH_WEIGHT),
        **{c: given(c, d) for c, d in REQUEST_DEFAULTS.items() if not c.endswith("_DIRECT")},
        **{f: given(f, 0) for f in request_flags},
        "CAISO": F.lit(0),
        K.OWNERSHIP: given(K.OWNERSHIP, DEFAULT_OWNERSHIP),
        K.REGION: given(region_source, DEFAULT_REGION),
    }
    return requests.withColumns(derived)


def batch_score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Append label, probability, confidence and message to every row."""
    scored = model.transform(rows)
    scored = scored.select(
        *[F.col(K.ident(c)) for c in rows.columns], positive_probability(scored).alias("_p")
    )
    return scored.withColumns(S.risk_verdict(F.col("_p"))).drop("_p")
