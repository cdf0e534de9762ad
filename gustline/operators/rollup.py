"""Events to one row per utility."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import contract as K
from ..functions import scalars as S

_ORDER, _BIT, _OTHER_MONTH = "_first_row", "_month_bit", "_other_month"


def numeric_flags(silver: DataFrame, flag_mode: str = "numeric") -> DataFrame:
    """Turn the region flags that are present from text into numbers."""
    return silver.withColumns(
        {
            f: S.region_flag(F.col(f), flag_mode)
            for f in K.GOLD_FLAGS
            if f in silver.columns
        }
    )


def utility_rollup(silver: DataFrame, flag_mode: str = "numeric") -> DataFrame:
    """One row per utility number from the columns that are present.

    Identity: first known value by ``_row_id`` (smallest value without that column).
    Reliability, magnitude and flags: maximum. Damage and harm: sum. Event types:
    count. Months: distinct count. Rows without a utility number are left out.

    Two steps keep every row-level aggregate a hash aggregate and every group small:
    first per utility x identity with fixed-width buffers (a utility that holds
    a third of all events is combined inside each task before the shuffle), then per
    utility over those few rows, where the text columns are picked. Months by their names are
    bits of a number; any other text is one more key of the first step and counted in the second.
    """
    have = set(silver.columns)
    events = numeric_flags(silver.filter(F.col(K.ident(K.KEY)).isNotNull()), flag_mode)

    def present(names) -> list[str]:
        return [n for n in names if n in have]

    identity = present((K.NAME, K.STATE, K.OWNERSHIP, K.REGION, K.COUNTIES))
    highest = present((*K.RELIABILITY, K.MAGNITUDE, *K.GOLD_FLAGS))
    summed = present((*K.DAMAGE, *K.HARM))
    months = present((K.MONTH,))

    partial = [F.max(c).alias(c) for c in highest]
    partial += [F.sum(c).alias(c) for c in summed]
    if K.EVENT_TYPE in have:
        partial.append(F.count(K.EVENT_TYPE).alias(K.EVENT_COUNT))
    if K.ROW_ID in have:
        partial.append(F.min(K.ROW_ID).alias(_ORDER))
    if months:
        spot = F.array_position(F.array(*map(F.lit, K.MONTH_NAMES)), F.col(K.MONTH)).cast("int")
        events = events.withColumns({_BIT: F.when(spot > 0, F.call_function("shiftleft", F.lit(1), spot - 1)),
                                     _OTHER_MONTH: F.when(spot == 0, F.col(K.MONTH))})
        partial.append(F.bit_or(_BIT).alias(_BIT))
    keys = [K.KEY, *identity, *([_OTHER_MONTH] if months else [])]
    fine = events.groupBy(*map(K.ident, keys)).agg(*(partial or [F.count(F.lit(1)).alias("_rows")]))

    def first_known(name: str):
        value = F.col(K.ident(name))
        if K.ROW_ID not in have:
            return F.min(value).alias(name)
        return F.min_by(value, F.when(value.isNotNull(), F.col(_ORDER))).alias(name)

    final = [first_known(c) for c in identity]
    final += [F.max(c).alias(c) for c in present(K.RELIABILITY)]
    final += [F.sum(c).alias(K.RENAMED_SUMS.get(c, c)) for c in summed]
    if K.EVENT_TYPE in have:
        final.append(F.sum(K.EVENT_COUNT).alias(K.EVENT_COUNT))
    if months:
        named = F.coalesce(F.bit_count(F.bit_or(_BIT)), F.lit(0)).cast("bigint")
        final.append((named + F.count_distinct(_OTHER_MONTH)).alias(K.MONTH_COUNT))
    final += [F.max(c).alias(c) for c in present((K.MAGNITUDE, *K.GOLD_FLAGS))]
    utilities = fine.groupBy(K.ident(K.KEY)).agg(*final)

    property_total, crops_total = K.RENAMED_SUMS.values()
    if property_total in utilities.columns:
        crops = F.col(crops_total) if crops_total in utilities.columns else F.lit(0.0)
        utilities = utilities.withColumn(
            K.TOTAL_DAMAGE,
            F.coalesce(property_total, F.lit(0.0)) + F.coalesce(crops, F.lit(0.0)),
        )
    return utilities
