"""Contract selection, typing, row rules, quarantine split and exact de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
import warnings

from pyspark.sql import Column, DataFrame, functions as F

from .. import contract as K
from ..functions import scalars as S


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail before any job runs when a required column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise K.ContractError(f"required columns are missing: {missing}")


def select_contract(
    df: DataFrame, columns: Sequence[str] = K.EVENT_CONTRACT, mode: str = "strict"
) -> DataFrame:
    """Keep the contract columns. ``strict`` fails on a gap, ``tolerant`` warns."""
    if mode == "strict":
        require_columns(df, columns)
    elif mode == "tolerant":
        absent = [c for c in columns if c not in df.columns]
        if absent:
            warnings.warn(f"columns not found: {absent}", stacklevel=2)
    else:
        raise ValueError(f"mode must be 'strict' or 'tolerant', not {mode!r}")
    return df.select(*[K.ident(c) for c in columns if c in df.columns])


def raw_number(column: str) -> Column:
    return S.strict_double(F.col(K.ident(column)))


#: Where ``with_numbers`` keeps the number of a text column.
NUMBERS = {c: f"_number{i}" for i, c in enumerate((K.KEY, *K.FLOAT_COLUMNS))}


def with_numbers(bronze: DataFrame) -> DataFrame:
    """Every numeric cell parsed once, for all that count, reject or type it, and the reject reason."""
    require_columns(bronze, K.EVENT_CONTRACT)
    numbers = bronze.withColumns({held: raw_number(c) for c, held in NUMBERS.items()})
    below = [F.coalesce(F.col(NUMBERS[c]) < 0, F.lit(False)) for c in K.NON_NEGATIVE_COLUMNS]
    return numbers.withColumn(K.REJECT_REASON, _reason(below))


def _reason(negative: Sequence[Column]) -> Column:
    state = F.col(K.ident(K.STATE))
    return F.when(state.isNull() | ~state.isin(*K.STATES), F.lit(K.INVALID_STATE)).when(
        reduce(lambda a, b: a | b, negative), F.lit(K.NEGATIVE_VALUE)
    )


def reject_reason() -> Column:
    """Reason code of a raw row, first match wins; NULL when the row is fine."""
    return _reason([S.negative_number(F.col(K.ident(c))) for c in K.NON_NEGATIVE_COLUMNS])


def typed_columns(damage_mode: str = "numeric", parsed: bool = False) -> list[Column]:
    """The 38 Silver columns as expressions over raw text columns.

    With ``parsed`` the numbers are those that ``with_numbers`` has read.
    """
    if damage_mode not in ("numeric", "suffix"):
        raise ValueError(f"damage mode must be 'numeric' or 'suffix', not {damage_mode!r}")
    out = []
    for name in K.EVENT_CONTRACT:
        raw = F.col(K.ident(name))
        number = F.col(NUMBERS[name]) if parsed and name in NUMBERS else S.strict_double(raw)
        if name in K.DAMAGE and damage_mode == "suffix":
            value = S.damage_usd(raw)
        elif name in K.FLOAT_COLUMNS:
            value = S.zero_filled(number)
        elif name == K.KEY:
            value = S.whole_key(number)
        elif name in K.DEFAULTED_TEXT:
            value = S.text_or_unknown(raw)
        else:
            value = raw
        out.append(value.alias(name))
    out.append(S.event_time(F.col(K.EVENT_TIME_TEXT)).alias(K.EVENT_TS))
    return out


def typed_events(bronze: DataFrame, damage_mode: str = "numeric") -> DataFrame:
    """``_row_id``, the 38 Silver columns and ``_reject_reason`` for every Bronze row."""
    require_columns(bronze, K.EVENT_CONTRACT)
    return bronze.select(
        F.col(K.ROW_ID), *typed_columns(damage_mode), reject_reason().alias(K.REJECT_REASON)
    )


def quarantined(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col(K.REJECT_REASON).isNotNull()).select(
        K.ROW_ID, K.REJECT_REASON, *[K.ident(c) for c in K.SILVER_COLUMNS]
    )


def accepted(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col(K.REJECT_REASON).isNull()).drop(K.REJECT_REASON)


def collapse_duplicates(
    df: DataFrame, columns: Sequence[str], order_key: str | None = K.ROW_ID
) -> DataFrame:
    """One row per distinct combination, with its lowest order key and copy count.

    A plain hash aggregate: copies of one row meet inside each task before the shuffle,
    so a group that holds a third of the table sends one row per task. NULLs are equal.
    """
    extra = [F.min(order_key).alias(order_key)] if order_key else []
    return df.groupBy(*[K.ident(c) for c in columns]).agg(
        *extra, F.count(F.lit(1)).alias(K.COPIES)
    )


def silver_events(typed: DataFrame) -> DataFrame:
    """The distinct accepted events: 38 contract columns plus ``_row_id`` and ``_copies``.

    The event time follows from its text, so rows that agree in the 37 given columns are copies;
    it is read afterwards, once for each distinct event, and not at all if nobody asks for it.
    """
    distinct = collapse_duplicates(accepted(typed), K.EVENT_CONTRACT)
    event_ts = S.event_time(F.col(K.EVENT_TIME_TEXT)).alias(K.EVENT_TS)
    return distinct.select(*[K.ident(c) for c in K.EVENT_CONTRACT], event_ts, K.ROW_ID, K.COPIES)


def clean_tolerant(df: DataFrame, damage_copies: bool = False) -> DataFrame:
    """The tolerant cleaner: keep what exists, drop foreign states, no quarantine.

    Text is filled first and stripped second; spreadsheet tokens count as missing.
    ``damage_copies`` adds each damage column once more under ``<name>_USD``.
    """
    kept = select_contract(df, mode="tolerant")
    if K.STATE in kept.columns:
        kept = kept.filter(F.col(K.STATE).isin(*K.STATES))
    cleaned = {}
    for name in kept.columns:
        raw = F.col(K.ident(name))
        if name in K.FLOAT_COLUMNS:
            cleaned[name] = S.coerced(raw)
        elif name in K.DEFAULTED_TEXT:
            cleaned[name] = S.filled_then_stripped(raw)
        elif name == K.KEY:
            cleaned[name] = S.integer_key(raw)
        else:
            cleaned[name] = S.missing_to_null(raw)
        if damage_copies and name in K.DAMAGE:
            cleaned[f"{name}_USD"] = S.coerced(raw)
    return kept.select(*[value.alias(name) for name, value in cleaned.items()]).distinct()


def with_absent_columns(df: DataFrame, columns: Sequence[str], value: object = 0) -> DataFrame:
    """Add each missing column as a constant."""
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})
