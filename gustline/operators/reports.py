"""The tables behind a risk report. Every function takes the utility table (Gold)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import contract as K
from ..functions import scalars as S
from ..session import stage
from .ranking import exact_quantiles, min_max_scaled, quantile_array

ALL_STATES, ALL_TYPES, ALL_REGIONS = "All States", "All Types", "All Regions"
SUMMARY_LABELS = (K.LABEL, "risk_label", "is_high_risk")
HISTOGRAM_BINS = 40

STATE_METRICS = ("saidi", "highrisk", "damage", "loss")


def _is_high() -> Column:
    return F.col(K.TIER) == K.HIGH


def _count_high() -> Column:
    return F.count(F.when(_is_high(), F.lit(1)))


#: What the additive tables need of a group of utilities: the column it is from, and how.
_MEASURES = {
    "avg_saidi": (K.SAIDI, F.avg),
    "loss": (K.LOSS, F.sum),
    "avg_loss": (K.LOSS, F.avg),
    "breaches": (K.BREACH, lambda x: F.sum(x).cast("bigint")),
    "events": (K.EVENT_COUNT, lambda x: F.sum(x).cast("bigint")),
    "avg_events": (K.EVENT_COUNT, lambda x: F.sum(x) / F.count(x)),
    "avg_label": (K.LABEL, lambda x: F.sum(x) / F.count(x)),
    "damage": (K.TOTAL_DAMAGE, F.sum),
    "avg_damage": (K.TOTAL_DAMAGE, F.avg),
    "avg_human": (K.HUMAN_IMPACT, F.avg),
}


def _measures(columns: Sequence[str]) -> list[Column]:
    """Every measure of the columns that a table has."""
    of_columns = [made(F.col(c)).alias(name) for name, (c, made) in _MEASURES.items() if c in columns]
    high = [_count_high().alias("high")] if K.TIER in columns else []
    return [F.count(F.lit(1)).alias("utilities"), *high, *of_columns]


class Cube:
    """All measures of a selection for every set of keys of the additive tables, from one scan.

    Those tables take either a selection, of which each scans its own columns, or its cube,
    whose rows are a state, a region, an ownership and tier each.
    """

    SETS = ((), (K.STATE,), (K.REGION,), (K.OWNERSHIP,), (K.TIER,), (K.OWNERSHIP, K.TIER))

    def __init__(self, selected: DataFrame) -> None:
        self._keys = list(dict.fromkeys(k for s in self.SETS for k in s))
        columns = {k: F.col(K.ident(k)) for k in self._keys}
        grouped = selected.groupingSets([[columns[k] for k in s] for s in self.SETS], *columns.values())
        left_out = [F.grouping(c).alias(f"_without{i}") for i, c in enumerate(columns.values())]
        self._rows = stage(grouped.agg(*left_out, *_measures(selected.columns)), "cube")

    def by(self, *wanted: str) -> DataFrame:
        """The groups of one set; the empty set has one row for an empty selection, too."""
        found = self._rows
        for i, k in enumerate(self._keys):
            found = found.filter(F.col(f"_without{i}") == (0 if k in wanted else 1))
        names = [c for c in found.columns if c not in self._keys and not c.startswith("_without")]
        if wanted:
            return found.select(*[K.ident(k) for k in wanted], *names)
        counts = {c: F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("utilities", "high")}
        return found.agg(*[counts.get(c, F.max(c).alias(c)) for c in names])


def measures_by(selected: DataFrame | Cube, *keys: str) -> DataFrame:
    """One row per combination of ``keys`` with every measure; unused ones are pruned."""
    if isinstance(selected, Cube):
        return selected.by(*keys)
    return selected.groupBy(*[K.ident(k) for k in keys]).agg(*_measures(selected.columns))


def _commonest(groups: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` groups with the most utilities, ties by name."""
    quoted = K.ident(key)
    return groups.filter(F.col(quoted).isNotNull()).orderBy(F.desc("utilities"), quoted).limit(k)


def state_risk_summary(features: DataFrame) -> DataFrame | None:
    """Utilities and high-risk share per state; None when state or label is absent."""
    lowered = {c.lower(): c for c in features.columns}
    label = next((lowered[c] for c in SUMMARY_LABELS if c in lowered), None)
    if label is None or K.STATE not in features.columns:
        return None
    flagged = F.col(label).cast("int")
    return (
        features.groupBy(F.col(K.STATE).alias("state"))
        .agg(
            F.count(F.lit(1)).alias("utilities"),
            F.sum(flagged).alias("high_risk_utilities"),
        )
        .withColumn(
            "high_risk_pct",
            F.round(F.lit(100.0) * F.col("high_risk_utilities") / F.col("utilities"), 1),
        )
        .orderBy(F.desc("high_risk_utilities"), F.desc("utilities"), "state")
    )


def filtered(
    features: DataFrame,
    state: str | None = None,
    ownership: str | None = None,
    region: str | None = None,
    tiers: Sequence[str] = (),
    empty_fallback: bool = True,
) -> DataFrame:
    """Equality filters with "All ..." sentinels and tier membership.

    With ``empty_fallback`` a filter that matches nothing returns the whole table.
    """
    matches = F.lit(True)
    for column, wanted, everything in (
        (K.STATE, state, ALL_STATES),
        (K.OWNERSHIP, ownership, ALL_TYPES),
        (K.REGION, region, ALL_REGIONS),
    ):
        if wanted and wanted != everything:
            matches &= F.col(K.ident(column)) == wanted
    if tiers:
        matches &= F.col(K.TIER).isin(*tiers)
    matches = F.coalesce(matches, F.lit(False))
    if not empty_fallback:
        return features.filter(matches)
    found = features.filter(matches).agg(F.count(F.lit(1))).scalar()
    return features.filter(matches | (found == 0))


def kpi_row(selected: DataFrame | Cube, features: DataFrame) -> DataFrame:
    """Headline numbers of a selection, with its SAIDI distance to the whole table."""
    overall = features.agg(F.avg(F.col(K.SAIDI))).scalar()
    states = measures_by(selected, K.STATE).filter(F.col(K.STATE).isNotNull()).agg(F.count(F.lit(1))).scalar()
    row = measures_by(selected)
    share = F.lit(100.0) * F.col("high") / F.greatest(F.col("utilities"), F.lit(1))
    return row.select(
        "utilities", F.col("high").alias("high_risk"), states.alias("states"), "avg_saidi",
        F.col("loss").alias("annual_loss_usd"), F.col("breaches").alias("sla_breaches"),
        F.col("events").alias("storm_events"), share.alias("high_risk_pct"),
        (F.col("avg_saidi") - overall).alias("saidi_delta"),
    )


def top_findings(selected: DataFrame | Cube) -> DataFrame:
    """One row: leading state, ownership and region, and the loss in billions."""

    def leader(column: str, measure: str) -> Column:
        quoted = K.ident(column)
        ranked = measures_by(selected, column).filter(F.col(quoted).isNotNull())
        if measure == "high":
            ranked = ranked.filter(F.col(measure) > 0)
        first = ranked.orderBy(F.desc(measure), quoted).limit(1)
        return first.select(F.struct(F.col(quoted).alias("name"), F.col(measure).alias("measure"))).scalar()

    state, ownership = leader(K.STATE, "high"), leader(K.OWNERSHIP, "high")
    region = leader(K.REGION, "avg_saidi")
    absent = F.lit("N/A")
    return measures_by(selected).select((F.col("loss") / F.lit(1e9)).alias("loss_billion_usd")).select(
        F.coalesce(state.getField("name"), absent).alias("top_state"),
        F.coalesce(state.getField("measure"), F.lit(0)).alias("top_state_high_risk"),
        F.coalesce(ownership.getField("name"), absent).alias("top_ownership"),
        F.coalesce(region.getField("name"), absent).alias("worst_region"),
        "loss_billion_usd",
    )


def state_metric(selected: DataFrame | Cube, metric: str) -> DataFrame:
    """One value per state: mean SAIDI, high-risk percent, damage in B or loss in M."""
    value = {
        "saidi": F.col("avg_saidi"),
        "highrisk": F.lit(100.0) * F.col("high") / F.col("utilities"),
        "damage": F.col("damage") / F.lit(1e9),
    }.get(metric, F.col("loss") / F.lit(1e6))
    known = measures_by(selected, K.STATE).filter(F.col(K.STATE).isNotNull())
    return known.select(F.col(K.STATE).alias("state"), value.alias("value"))


def tier_mix(selected: DataFrame | Cube) -> DataFrame:
    """Utilities per tier with their percentage."""
    total = measures_by(selected).select("utilities").scalar()
    return measures_by(selected, K.TIER).select(
        F.col(K.TIER).alias("tier"), "utilities", (F.col("utilities") / total * F.lit(100.0)).alias("pct")
    )


def tier_by_ownership(selected: DataFrame | Cube, k: int = 6) -> DataFrame:
    """Utilities per ownership and tier for the ``k`` commonest ownerships."""
    top = _commonest(measures_by(selected, K.OWNERSHIP), K.OWNERSHIP, k).select(K.OWNERSHIP)
    fine = measures_by(selected, K.OWNERSHIP, K.TIER)
    return fine.join(F.broadcast(top), K.OWNERSHIP, "left_semi").select(  # at most k rows
        F.col(K.OWNERSHIP).alias("ownership"), F.col(K.TIER).alias("tier"), "utilities"
    )


def tier_quantiles(selected: DataFrame, column: str = K.SAIDI) -> DataFrame:
    """Five-number summary, mean and count per tier over 0 < x < the 95% quantile."""
    x = F.col(column)
    upper = quantile_array(selected, column, [0.95])
    kept = selected.withColumn("_upper", upper).filter((x > 0) & (x < F.col("_upper")[0]))
    kept = kept.select(K.TIER, column)
    spots = exact_quantiles(kept, column, [0.0, 0.25, 0.5, 0.75, 1.0], by=[K.TIER])
    sizes = kept.groupBy(K.TIER).agg(
        F.count(F.lit(1)).alias("utilities"), F.avg(F.col(column)).alias("mean")
    )
    names = ("minimum", "q25", "median", "q75", "maximum")
    return sizes.join(spots, K.TIER).select(
        F.col(K.TIER).alias("tier"),
        "utilities",
        "mean",
        *[F.col("q")[i].alias(n) for i, n in enumerate(names)],
    )


def score_histogram(selected: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Utilities per tier and equal-width score bin, with the 80% quantile line."""
    score = F.col(K.SCORE)
    span = selected.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi"))).scalar()
    lo, hi = F.col("_span.lo"), F.col("_span.hi")
    place = F.floor((score - lo) / (hi - lo) * F.lit(float(bins)))
    slot = F.when(hi > lo, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    line = quantile_array(selected, K.SCORE, [K.HIGH_QUANTILE])
    return (
        selected.withColumn("_span", span)
        .select(F.col(K.TIER).alias("tier"), slot.alias("bin"))
        .groupBy("tier", "bin")
        .agg(F.count(F.lit(1)).alias("utilities"))
        .withColumn("high_line", line[0])
    )


def region_heat(selected: DataFrame | Cube, k: int = 10) -> DataFrame:
    """Four means per region (the ``k`` commonest), raw and min-max scaled."""
    means = _commonest(measures_by(selected, K.REGION), K.REGION, k).select(
        F.col(K.ident(K.REGION)).alias("region"), "avg_saidi", F.col("avg_label").alias("pct_high"),
        F.col("avg_events").alias("avg_storms"), (F.col("avg_loss") / F.lit(1e6)).alias("avg_loss_musd"),
    )
    scaled = min_max_scaled(means, ["avg_saidi", "pct_high", "avg_storms", "avg_loss_musd"])
    return scaled.orderBy(F.desc("avg_saidi"), "region")


#: Dimensions of the radar and their measures.
RADAR = {
    "saidi": "avg_saidi", "high_risk": "avg_label", "storm_events": "avg_events",
    "damage": "avg_damage", "human_impact": "avg_human",
}


def region_radar(selected: DataFrame | Cube, k: int = 7) -> DataFrame:
    """Five min-max scaled means per region (the ``k`` commonest)."""
    means = _commonest(measures_by(selected, K.REGION), K.REGION, k).select(
        F.col(K.ident(K.REGION)).alias("region"), *[F.col(m).alias(name) for name, m in RADAR.items()]
    )
    return min_max_scaled(means, list(RADAR), suffix="").orderBy("region")


def bubble_points(selected: DataFrame) -> DataFrame:
    """Utilities with SAIDI, events and loss above zero; loss in M and a clipped size."""
    kept = selected.filter(
        (F.col(K.SAIDI) > 0) & (F.col(K.EVENT_COUNT) > 0) & (F.col(K.LOSS) > 0)
    ).withColumn("loss_musd", F.col(K.LOSS) / F.lit(1e6))
    largest = kept.agg(F.max("loss_musd")).scalar()
    size = F.col("loss_musd") / largest * F.lit(40.0) + F.lit(5.0)
    return kept.select(
        F.col(K.ident(K.KEY)).alias("utility_number"),
        F.col(K.TIER).alias("tier"),
        F.col(K.EVENT_COUNT).alias("storm_events"),
        F.col(K.SAIDI).alias("saidi"),
        "loss_musd",
        F.least(F.greatest(size, F.lit(4.0)), F.lit(45.0)).alias("size"),
        F.concat(
            F.coalesce(F.col(K.ident(K.NAME)), F.lit("")),
            F.lit(" | State: "),
            F.coalesce(F.col(K.STATE), F.lit("")),
            F.lit(" | SAIDI: "),
            S.half_even(F.col(K.SAIDI), 1).cast("string"),
            F.lit(" min/yr | Loss: $"),
            S.half_even(F.col("loss_musd"), 1).cast("string"),
            F.lit("M"),
        ).alias("hover"),
    )


def top_states(selected: DataFrame | Cube, k: int = 20) -> DataFrame:
    """The states with the most high-risk utilities."""
    known = measures_by(selected, K.STATE).filter((F.col("high") > 0) & F.col(K.STATE).isNotNull())
    return (
        known.select(F.col(K.STATE).alias("state"), F.col("high").alias("high_risk"))
        .orderBy(F.desc("high_risk"), "state").limit(k)
    )


def top_loss(selected: DataFrame, k: int = 20) -> DataFrame:
    """The utilities with the largest loss, labelled ``name (state)``."""
    return (
        selected.filter(F.col(K.LOSS) > 0)
        .orderBy(F.desc(K.LOSS), K.ident(K.KEY))
        .limit(k)
        .select(
            S.short_label(F.col(K.ident(K.NAME)), F.col(K.STATE)).alias("label"),
            F.col(K.TIER).alias("tier"),
            S.half_even(F.col(K.LOSS) / F.lit(1e6), 1).alias("loss_musd"),
        )
    )


# --- fixed values: display names of the ranking table
RANKING_NAMES = {
    K.NAME: K.NAME,
    K.STATE: K.STATE,
    K.OWNERSHIP: K.OWNERSHIP,
    K.REGION: K.REGION,
    K.TIER: "Risk Tier",
    K.SCORE: "Risk Score",
    K.SAIDI: "SAIDI (min/yr)",
    K.SAIFI: "SAIFI (x/yr)",
    K.EVENT_COUNT: "Storm Events",
    K.LOSS: "Est. Loss ($M)",
    K.BREACH: "NERC Breach",
}


def ranking_table(selected: DataFrame) -> DataFrame:
    """The display table: present columns, renamed and rounded, best score first."""
    rounded = {
        K.SCORE: lambda c: S.half_even(c, 4),
        K.SAIDI: lambda c: S.half_even(c, 1),
        K.LOSS: lambda c: S.half_even(c / F.lit(1e6), 1),
    }
    shown = [
        rounded.get(c, lambda x: x)(F.col(K.ident(c))).alias(title)
        for c, title in RANKING_NAMES.items()
        if c in selected.columns
    ]
    key = F.col(K.ident(K.KEY)).alias("_key")
    table = selected.select(*shown, key)
    if K.SCORE in selected.columns:
        table = table.orderBy(F.col(K.ident("Risk Score")).desc(), "_key")
    return table.drop("_key")


COMPARED = {
    "SAIDI (min/yr)": (K.SAIDI, 1.0),
    "SAIFI (x/yr)": (K.SAIFI, 1.0),
    "Risk Score": (K.SCORE, 1.0),
    "Storm Events": (K.EVENT_COUNT, 1.0),
    "Damage ($M)": (K.TOTAL_DAMAGE, 1e6),
    "Human Impact": (K.HUMAN_IMPACT, 1.0),
}


def compare_two(features: DataFrame, first: str, second: str) -> DataFrame:
    """Six metrics of two utilities side by side; empty unless both names exist.

    A name that occurs more than once stands for its lowest utility number.
    """
    metrics = F.array(
        *[
            F.struct(
                F.lit(label).alias("metric"),
                (
                    S.half_even(F.col(column).cast("double") / F.lit(divisor), 3)
                    if column in features.columns
                    else F.lit(0.0)
                ).alias("value"),
            )
            for label, (column, divisor) in COMPARED.items()
        ]
    )
    name = F.col(K.ident(K.NAME))

    def one(wanted: str, out: str) -> DataFrame:
        return (
            features.filter(name == wanted)
            .agg(F.min_by(metrics, F.col(K.ident(K.KEY))).alias("m"))
            .select(F.inline("m"))
            .withColumnRenamed("value", out)
        )

    return one(first, "first").join(one(second, "second"), "metric")


def value_list(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Distinct known values in order, optionally only the first ``k``."""
    quoted = K.ident(column)
    out = df.select(F.col(quoted).alias("value")).filter("value is not null").distinct()
    out = out.orderBy("value")
    return out.limit(k) if k is not None else out


def label_balance(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Rows and percentage per class."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.groupBy(F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("pct", F.col("rows") / total * F.lit(100.0))
    )
