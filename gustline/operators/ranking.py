"""Ranks, quantiles and score metrics that never sort the rows in one task.

Spark's mergeable quantile summary gives, in one scan, values whose ranks are off by at most a
ten-thousandth of the rows. Quantiles count exactly inside narrow brackets around them; ranks and
running totals cut the rows into value ranges at them, count the ranges exactly, and sort inside
each. What comes to the driver is a few numbers for each shuffle partition, whatever the size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import contract as K
from ..session import stage

#: The summary's ranks are off by at most one row in ACCURACY; brackets reach ten times as far.
ACCURACY = 10_000
SLACK = 10 / ACCURACY
#: Below so many rows, where one rank is more than the summary's error, a bracket holds all values.
FEW = ACCURACY
#: Brackets of more groups are joined by a shuffle.
BROADCAST_GROUPS = 100_000

VALUE, RANGE, LANE, GAP, POINTS, SERIES = "_value", "_range", "_lane", "_gap", "_points", "_series"


def missing_as_null(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _brackets(x: Column, shares: Sequence[float]) -> Column:
    """Two values for each share, between which its quantile surely lies."""
    points = [min(max(s + side, 0.0), 1.0) for s in shares for side in (-SLACK, SLACK)]
    everything = F.lit([float("-inf"), float("inf")] * len(shares))
    return F.when(F.count(x) < FEW, everything).otherwise(F.percentile_approx(x, points, ACCURACY))


def exact_quantiles(
    df: DataFrame,
    column: str,
    shares: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles, one array column ``q`` per group (missing ignored).

    One scan brackets each quantile, a second counts the distinct values inside the brackets and
    the rows between them, so nothing but a few thousandths of the values is ever sorted.
    """
    groups = [K.ident(b) for b in by]
    rows = df.select(*groups, missing_as_null(F.col(K.ident(column))).alias(VALUE))
    rows = rows.filter(F.col(VALUE).isNotNull())
    summary = _brackets(F.col(VALUE), shares).alias(POINTS)
    if groups:
        found = stage(rows.groupBy(*groups).agg(summary), "brackets")
        side = found.toDF(*[f"_g{i}" for i in range(len(groups))], POINTS)
        if side.count() <= BROADCAST_GROUPS:
            side = F.broadcast(side)
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])
        rows = rows.join(side, same).select(*groups, VALUE, POINTS)
    else:
        rows = rows.withColumn(POINTS, rows.agg(summary).scalar())
    x, points = F.col(VALUE), F.col(POINTS)
    inside = reduce(lambda a, b: a | b, [(x >= points[2 * i]) & (x <= points[2 * i + 1]) for i in range(len(shares))])
    # rows outside are counted behind the last bracket that ends below them
    ends = F.array(*[points[2 * i + 1] for i in range(len(shares))])
    place = F.when(inside, x).otherwise(F.coalesce(F.array_max(F.filter(ends, lambda e: e < x)), F.lit(float("-inf"))))
    counts = rows.select(*groups, place.alias(VALUE), (~inside).alias(GAP)).groupBy(*groups, VALUE, GAP).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*(groups or [F.lit(0)]))
    behind = F.sum("n").over(group.orderBy(VALUE, GAP).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = counts.withColumns({"_behind": behind, "_total": F.sum("n").over(group)})
    first = F.col("_behind") - F.col("n")
    picked = []
    for i, share in enumerate(shares):
        spot = F.lit(float(share)) * (F.col("_total") - 1)
        for name, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            held = ~F.col(GAP) & (first <= rank) & (rank < F.col("_behind"))
            picked.append(F.max(F.when(held, F.col(VALUE))).alias(f"{name}{i}"))
    edges = totals.groupBy(*groups).agg(F.max("_total").alias("_total"), *picked)
    blended = []
    for i, share in enumerate(shares):
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        spot = F.lit(float(share)) * (F.col("_total") - 1)
        part = spot - F.floor(spot)
        step = hi - lo
        # Blend from the nearer end, so equal ends give exactly that value.
        value = F.when(part < 0.5, lo + step * part).otherwise(hi - step * (1 - part))
        missed = F.raise_error(F.lit(f"the summary missed the quantile {share} of {column}")).cast("double")
        blended.append(F.when(F.col("_total").isNotNull() & (lo.isNull() | hi.isNull()), missed).otherwise(value))
    return edges.select(*groups, F.array(*blended).alias("q"))


def quantile_array(df: DataFrame, column: str, shares: Sequence[float]) -> Column:
    """The quantiles of a whole table as a scalar (array) to use inside expressions."""
    return exact_quantiles(df, column, shares).scalar()


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of several columns in two scans; what is collected is a row per column."""
    values = [missing_as_null(F.col(K.ident(c))) for c in columns]
    if not columns:
        return {}
    points = df.agg(*[_brackets(x, [0.5]) for x in values]).first()
    cells = []
    for i in range(len(columns)):
        low, high = points[i]
        # -1 below the bracket, 0 inside, 1 above
        gap = F.when(values[i] < low, -1).when(values[i] > high, 1).otherwise(0)
        inside = F.when((values[i] >= low) & (values[i] <= high), values[i])
        cells.append(F.when(values[i].isNotNull(), F.struct(F.lit(i).alias(SERIES), gap.alias(GAP), inside.alias(VALUE))))
    long = df.select(F.explode(F.array(*cells)).alias("cell")).filter("cell is not null").select("cell.*")
    counts = long.groupBy(SERIES, GAP, VALUE).agg(F.count(F.lit(1)).alias("n"))
    series = Window.partitionBy(SERIES)
    behind = F.sum("n").over(series.orderBy(GAP, VALUE).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = counts.withColumns({"_behind": behind, "_last": F.sum("n").over(series) - 1})
    first = F.col("_behind") - F.col("n")
    low, high = F.floor(F.col("_last") / 2.0), F.ceil(F.col("_last") / 2.0)
    middle = totals.groupBy(SERIES).agg(
        *[F.max(F.when((first <= r) & (r < F.col("_behind")), F.col(VALUE))).alias(n) for n, r in (("lo", low), ("hi", high))]
    )
    out = {columns[r[SERIES]]: (r["lo"], r["hi"]) for r in middle.collect()}
    if any(edge is None for pair in out.values() for edge in pair):
        raise RuntimeError(f"the summary missed a median: {out}")
    return {c: (lo + hi) / 2.0 for c, (lo, hi) in out.items()}


class _Ranges:
    """Value ranges between cuts, and the values so frequent that several cuts fall on them."""

    def __init__(self, cuts: Sequence[float] | None) -> None:
        found = list(cuts or [])
        self.cuts = sorted(set(found))
        self.hot = sorted({a for a, b in zip(found, found[1:]) if a == b})

    def of(self, x: Column) -> Column:
        """The number of cuts below a value: those of whole blocks first, then inside one block."""
        if not self.cuts:
            return F.when(x.isNotNull(), 0)
        width = isqrt(len(self.cuts)) + 1
        blocks = [self.cuts[i : i + width] for i in range(0, len(self.cuts), width)]
        whole = F.size(F.filter(F.lit([b[-1] for b in blocks]), lambda cut: cut < x))
        inner = F.get(F.lit(blocks), whole)
        below = F.when(inner.isNull(), len(self.cuts)).otherwise(whole * width + F.size(F.filter(inner, lambda cut: cut < x)))
        return F.when(x.isNotNull(), below)

    def is_hot(self, x: Column) -> Column:
        return F.coalesce(x.isin(*self.hot), F.lit(False)) if self.hot else F.lit(False)


def _even_cuts(x: Column, parts: int) -> Column:
    return F.percentile_approx(x, [i / parts for i in range(1, parts)] or [0.5], ACCURACY)


def with_percent_rank(
    df: DataFrame, columns: Mapping[str, str], key: Sequence[str]
) -> DataFrame:
    """Average-tie percentile rank: mean rank of the tie group / row count.

    ``columns`` maps each output name to the column it ranks; ``key`` identifies a row.
    Missing values (NULL or NaN) rank last as one tie group. ``df`` is read three times: pass a
    stored or staged table. One scan cuts all columns into a range for each shuffle partition, one
    counts the ranges; then the rows are sorted inside the ranges of one column after another.
    Values that fill a range, and missing ones, have their rank from the counts alone, and
    their rows go to lanes by their key.
    """
    parts = shuffle_partitions(df.sparkSession)
    values = {name: missing_as_null(F.col(K.ident(c))) for name, c in columns.items()}
    cut = df.agg(*[_even_cuts(x, parts) for x in values.values()]).first()
    ranges = {name: _Ranges(cut[i]) for i, name in enumerate(columns)}
    cells = [
        F.struct(F.lit(name).alias(SERIES), r.of(x).alias(RANGE), F.when(r.is_hot(x), x).alias(VALUE))
        for (name, x), r in zip(values.items(), ranges.values())
    ]
    # at most two rows for each range of each column
    counted = df.select(F.inline(F.array(*cells))).groupBy(SERIES, RANGE, VALUE).agg(F.count(F.lit(1)).alias("n")).collect()
    out = df
    for name, r in ranges.items():
        mine = {(c[RANGE], c[VALUE]): c["n"] for c in counted if c[SERIES] == name}
        total = sum(mine.values())
        offsets, hot_ranks, behind = [], {}, 0
        for number in range(len(r.cuts) + 1):
            offsets.append(behind)
            behind += mine.get((number, None), 0)
            for value in r.hot:  # the largest of its range
                n = mine.get((number, value))
                if n:
                    hot_ranks[value] = behind + (n + 1) / 2.0
                    behind += n
        x = values[name]
        looked_up = F.when(x.isNull(), F.lit(behind + (total - behind + 1) / 2.0))
        if hot_ranks:
            place = F.array_position(F.lit([float(v) for v in hot_ranks]), F.col(VALUE))
            looked_up = looked_up.when(r.is_hot(F.col(VALUE)), F.get(F.lit(list(hot_ranks.values())), (place - 1).cast("int")))
        lane = F.when(x.isNull() | r.is_hot(x), 1 + F.pmod(F.xxhash64(*[K.ident(k) for k in key]), F.lit(parts))).otherwise(F.lit(0))
        out = out.withColumns({VALUE: x, RANGE: r.of(x), LANE: lane})
        inside = Window.partitionBy(RANGE, LANE).orderBy(VALUE)
        ties = F.count(F.lit(1)).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
        own = F.get(F.lit(offsets), F.col(RANGE)) + F.rank().over(inside) - 1 + (ties + 1) / F.lit(2.0)
        rank = F.coalesce(looked_up, own)
        out = out.withColumn(name, rank / F.lit(total)).drop(VALUE, RANGE, LANE)
    return out


def min_max_scaled(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """``(x - min) / (max - min + 1e-9)`` over all rows of ``df``."""
    spans = df.agg(
        F.struct(
            *[F.min(c).alias(f"min_{c}") for c in columns],
            *[F.max(c).alias(f"max_{c}") for c in columns],
        )
    ).scalar()
    low = {c: F.col("_span").getField(f"min_{c}") for c in columns}
    high = {c: F.col("_span").getField(f"max_{c}") for c in columns}
    scaled = {
        f"{c}{suffix}": (F.col(c) - low[c]) / (high[c] - low[c] + F.lit(1e-9)) for c in columns
    }
    return df.withColumn("_span", spans).withColumns(scaled).drop("_span")


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: ``pos`` and ``neg``, with ``_before`` (smaller scores) and ``_total``.

    A NULL score counts as the largest. The distinct scores are stored once, cut into
    ranges, and summed inside them; the ranges' sums come to the driver.
    """
    source = df.select(F.col(score).cast("double").alias(VALUE), F.col(label).alias("y"))
    counts = stage(
        source.groupBy(VALUE).agg(
            F.sum((F.col("y") == 1).cast("bigint")).alias("pos"),
            F.sum((F.col("y") == 0).cast("bigint")).alias("neg"),
        ),
        "scores",
    )
    ranges = _Ranges(counts.agg(_even_cuts(F.col(VALUE), shuffle_partitions(df.sparkSession))).first()[0])
    last = len(ranges.cuts) + 1
    ranged = counts.withColumn(RANGE, F.coalesce(ranges.of(F.col(VALUE)), F.lit(last)))
    sums = {r[RANGE]: r for r in ranged.groupBy(RANGE).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}
    inside = (
        Window.partitionBy(RANGE).orderBy(F.col(VALUE).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    more = {}
    for m in ("pos", "neg"):
        *offsets, total = accumulate((sums[i][m] or 0 if i in sums else 0 for i in range(last + 1)), initial=0)
        more[f"{m}_before"] = F.get(F.lit(offsets), F.col(RANGE)) + F.sum(m).over(inside) - F.col(m)
        more[f"{m}_total"] = F.lit(total).cast("bigint")
    return ranged.withColumns(more).drop(RANGE)


def precision_recall_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """Running precision and recall at every distinct score, highest score first."""
    hits = F.col("pos_total") - F.col("pos_before")
    false_alarms = F.col("neg_total") - F.col("neg_before")
    return _score_counts(df, score, label).select(
        F.col(VALUE).alias("score"),
        "pos", "neg", "pos_total", "neg_total", "pos_before", "neg_before",
        hits.alias("tp"),
        false_alarms.alias("fp"),
        (hits / (hits + false_alarms)).alias("precision"),
        (hits / F.col("pos_total")).alias("recall"),
    )


def binary_metrics(
    df: DataFrame, score: str, label: str, threshold: float = 0.5
) -> DataFrame:
    """One row: ROC-AUC, average precision, F1, precision, recall (zero division gives 0)."""
    points = precision_recall_points(df, score, label)
    called = F.col("score") >= threshold
    pairs_won = F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    sums = points.agg(
        F.sum(pairs_won).alias("won"),
        F.sum(F.col("pos") * F.col("precision")).alias("ap"),
        F.max("pos_total").alias("p"),
        F.max("neg_total").alias("n"),
        F.sum(F.when(called, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(called, F.col("neg")).otherwise(0)).alias("fp"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    tp, fp, p = F.col("tp"), F.col("fp"), F.col("p")
    return sums.select(
        F.try_divide(F.col("won"), p * F.col("n").cast("double")).alias("roc_auc"),
        F.try_divide(F.col("ap"), p).alias("pr_auc"),
        ratio(2.0 * tp, tp + fp + p).alias("f1"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, p).alias("recall"),
        p.alias("positives"),
        (p + F.col("n")).alias("rows"),
    )
