"""The given tables seen as a raw utility x storm-event feed.

Every order line is a storm event in the territory of the customer that placed the
order; the customer is the utility. Text cells carry the usual dirt (blanks, padding,
unreadable numbers, foreign states). Lines still open were delivered twice, which is
where exact duplicates come from.

The cell expressions are plain SQL that Spark and other engines read alike, so a
checker can build the same feed; joins and columns are DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contract as K
from ..operators.joins import exposure_join

# 25 codes, one per nation: 23 states and two codes that are not states.
STATE_CODES = "ALAKAZARCACOCTDEFLGAHIIDILINIAKSKYLAMEMDMAMIMNDCCN"
MONTHS_BY_NINE = "".join(
    m.ljust(9)
    for m in (
        "January February March April May June July August September October November December"
    ).split()
)
MONTHS_BY_THREE = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"

LINE = "l_linenumber"


def whole(expression: str) -> str:
    """Integer text: decimals print differently from engine to engine."""
    return f"CAST(CAST(floor({expression}) AS BIGINT) AS STRING)"


def on_line_one(expression: str, otherwise: str) -> str:
    """Yearly reliability figures sit on one line of an order only."""
    return f"CASE WHEN {LINE} = 1 THEN {expression} ELSE {otherwise} END"


def _flag(position: int) -> str:
    yes, no = ("'Y'", "''") if position % 2 == 0 else ("'1'", "'0'")
    return f"CASE WHEN c_nationkey % 15 = {position} THEN {yes} ELSE {no} END"


DAY = "lpad(CAST(day(l_shipdate) AS STRING), 2, '0')"
YEAR = "lpad(CAST(year(l_shipdate) % 100 AS STRING), 2, '0')"
MON = f"substr('{MONTHS_BY_THREE}', (month(l_shipdate) - 1) * 3 + 1, 3)"

CELLS: dict[str, str] = {
    K.KEY: f"CASE WHEN o_orderstatus = 'P' AND {LINE} = 7 THEN 'n/a' "
           f"ELSE CAST(c_custkey AS STRING) || '.0' END",
    K.NAME: "c_name",
    K.STATE: f"substr('{STATE_CODES}', c_nationkey * 2 + 1, 2)",
    K.OWNERSHIP: "CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE ' ' || c_mktsegment END",
    K.REGION: "r_name || ' '",
    **{flag: _flag(i) for i, flag in enumerate(K.REGION_FLAGS)},
    K.COUNTIES: "CAST(c_custkey % 7 AS STRING)",
    K.RELIABILITY[0]: f"CASE WHEN {LINE} = 1 THEN {whole('c_acctbal / 10')} || '.5' "
                      f"WHEN {LINE} = 7 THEN 'N/A' WHEN {LINE} = 6 THEN 'NaN' ELSE '' END",
    K.RELIABILITY[1]: on_line_one("CAST(c_custkey % 37 AS STRING) || '.25'", "'0'"),
    K.RELIABILITY[2]: on_line_one("CAST(c_custkey % 120 AS STRING)", "''"),
    K.RELIABILITY[3]: on_line_one(whole("abs(c_acctbal) / 20"), "'--'"),
    K.RELIABILITY[4]: on_line_one("CAST(c_custkey % 11 AS STRING)", "''"),
    K.RELIABILITY[5]: on_line_one("CAST(c_custkey % 90 AS STRING)", "'0.0'"),
    K.EVENT_TYPE: "CASE l_returnflag WHEN 'A' THEN 'Hail' WHEN 'N' THEN ' Thunderstorm Wind ' "
                  "ELSE '' END",
    K.MONTH: f"trim(substr('{MONTHS_BY_NINE}', (month(l_shipdate) - 1) * 9 + 1, 9))",
    K.MAGNITUDE: f"CASE WHEN {LINE} = 7 THEN 'N/A' WHEN {LINE} = 6 THEN '' "
                 f"WHEN {LINE} = 5 THEN 'NaN' WHEN {LINE} = 4 THEN {whole('l_quantity')} || 'd' "
                 f"ELSE ' ' || {whole('l_quantity')} END",
    # quarters add up to the same in any order
    K.DAMAGE[0]: f"{whole('l_extendedprice')} || CASE {LINE} % 4 WHEN 1 THEN '.25' "
                 f"WHEN 2 THEN '.5' WHEN 3 THEN '.75' ELSE '.0' END",
    K.DAMAGE[1]: f"CASE WHEN l_returnflag = 'R' THEN {whole('l_extendedprice * l_tax')} "
                 f"ELSE '' END",
    K.HARM[0]: f"CASE WHEN l_returnflag = 'R' THEN CAST({LINE} - 1 AS STRING) ELSE '0' END",
    K.HARM[1]: f"CASE WHEN l_returnflag = 'N' THEN CAST({LINE} % 3 AS STRING) ELSE '' END",
    K.HARM[2]: f"CASE WHEN l_returnflag = 'A' AND {LINE} = 2 THEN '1' ELSE '0' END",
    K.HARM[3]: "''",
    K.EVENT_TIME_TEXT: f"CASE WHEN l_linestatus = 'F' AND {LINE} = 4 THEN 'unknown' "
                       f"ELSE {DAY} || '-' || {MON} || '-' || {YEAR} || ' ' || "
                       f"lpad(CAST({LINE} AS STRING), 2, '0') || ':40:00' END",
}
ROW_NUMBER = f"l_orderkey * 16 + {LINE} * 2 + delivery - 1"
DAMAGE_TEXT = (
    f"CASE {LINE} WHEN 1 THEN '$' || {whole('l_quantity')} || '.5M' "
    f"WHEN 2 THEN {whole('l_quantity')} || 'k' WHEN 3 THEN ' $2B ' "
    f"WHEN 4 THEN {whole('l_quantity')} || ',000' WHEN 5 THEN 'N/A' WHEN 6 THEN '' "
    f"ELSE {whole('l_extendedprice')} END"
)


# one of four ways to write an order's date, with a time made from its key
CLOCK = ("o_orderkey % 24", "o_orderkey % 60", "(o_orderkey + day(o_orderdate)) % 60")
_LOOSE_DATE = (
    "CAST(day(o_orderdate) AS STRING) || '-' || "
    f"substr('{MONTHS_BY_THREE}', (month(o_orderdate) - 1) * 3 + 1, 3) || '-' || "
    "lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0')"
)
_LOOSE_CLOCK = " || ':' || ".join(f"CAST({part} AS STRING)" for part in CLOCK)
LOOSE_TIME = (
    f"CASE o_orderkey % 4 WHEN 0 THEN ' ' || {_LOOSE_DATE} || ' ' || {_LOOSE_CLOCK} "
    f"WHEN 1 THEN {_LOOSE_DATE} || '   ' || {_LOOSE_CLOCK} || '  ' "
    f"WHEN 2 THEN lower({_LOOSE_DATE}) || ' noon' "
    f"ELSE lpad({_LOOSE_DATE}, 9, '0') || ' ' || {_LOOSE_CLOCK} END"
)


def tables(spark: SparkSession, sf_dir: str):
    return lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the customer, nation and region they belong to."""
    read = tables(spark, sf_dir)
    territory = (
        read("customer")
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnRenamed("c_custkey", "custkey")
    )
    orders = read("orders").withColumnRenamed("o_custkey", "custkey")
    located = exposure_join(territory, orders, ["custkey"]).withColumnRenamed("custkey", "c_custkey")
    # a hot customer's orders are spread by now, and an order has few lines
    return read("lineitem").join(located, F.col("l_orderkey") == F.col("o_orderkey"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as Bronze rows: 37 text columns and ``_row_id``.

    A line's cells are written once and then delivered as often as it came.
    """
    deliveries = F.explode(
        F.when(F.col("l_linestatus") == "O", F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1))
        )
    )
    cells = [F.expr(sql).alias(name) for name, sql in CELLS.items()]
    lines = exposure(spark, sf_dir).select(*cells, "l_orderkey", LINE, "l_linestatus").withColumn("delivery", deliveries)
    return lines.select(*[K.ident(c) for c in CELLS], F.expr(ROW_NUMBER).cast("bigint").alias(K.ROW_ID))


def damage_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables(spark, sf_dir)("lineitem")
    return lines.select("l_orderkey", LINE, F.expr(DAMAGE_TEXT).alias("damage_text"))
