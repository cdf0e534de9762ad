"""Plain SQL for the registered queries, to be run on the same tables by another engine."""

from __future__ import annotations

from collections.abc import Callable

from .. import contract as K
from ..functions.scalars import MISSING_TOKENS
from ..operators.joins import DEFAULT_CENTROID, STATE_CENTROIDS
from ..operators.reports import COMPARED, RANKING_NAMES
from . import feed

SQL: dict[str, str] = {}


def q(name: str) -> str:
    return '"' + name + '"'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(text(v) for v in values)


def check(function: Callable[[], str]) -> Callable[[], str]:
    SQL[function.__name__] = function()
    return function


# --- building blocks ------------------------------------------------------------------------

JOINED = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
RAW = (
    "raw AS (SELECT "
    + ", ".join(f"{sql} AS {q(name)}" for name, sql in feed.CELLS.items())
    + f", CAST({feed.ROW_NUMBER} AS BIGINT) AS _row_id FROM (SELECT *, "
    f"unnest(CASE WHEN l_linestatus = 'O' THEN [1, 2] ELSE [1] END) AS delivery FROM {JOINED}))"
)


def number(column: str) -> str:
    return f"TRY_CAST(trim({q(column)}) AS DOUBLE)"


def filled(expression: str) -> str:
    return (
        f"CASE WHEN {expression} IS NULL OR isnan({expression}) THEN CAST(0 AS DOUBLE) "
        f"ELSE {expression} END"
    )


def whole_key(expression: str) -> str:
    return f"TRY_CAST({expression} AS BIGINT)"


def defaulted(column: str) -> str:
    return f"coalesce(nullif(trim({q(column)}), ''), 'Unknown')"


def _kinds() -> str:
    """A table of the contract's fields and the rule that each one's cells go by."""
    rules = {c: "plain" for c in K.EVENT_CONTRACT}
    rules |= {c: "label" for c in K.DEFAULTED_TEXT} | {c: "number" for c in K.FLOAT_COLUMNS} | {K.KEY: "key"}
    return ", ".join(f"({text(c)}, {text(rule)})" for c, rule in rules.items())


def _of(field: str, value: str) -> str:
    """The one cell of a row that belongs to ``field``."""
    return f"max({value}) FILTER (WHERE field = {text(field)})"


def _typed() -> str:
    columns = []
    for c in K.EVENT_CONTRACT:
        if c in K.FLOAT_COLUMNS:
            value = f"coalesce({_of(c, 'amount')}, 0)"
        elif c == K.KEY:
            value = f"TRY_CAST({_of(c, 'amount')} AS BIGINT)"
        else:
            value = _of(c, "label" if c in K.DEFAULTED_TEXT else "cell")
        columns.append(f"{value} AS {q(c)}")
    known = f"count(*) FILTER (WHERE field = 'State' AND cell IN ({listed(K.STATES)}))"
    below = f"count(*) FILTER (WHERE amount < 0 AND field IN ({listed(K.NON_NEGATIVE_COLUMNS)}))"
    return (
        f"kinds(field, kind) AS (VALUES {_kinds()}), "
        # one row per cell, so that every rule is stated once and not per column
        "numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS line FROM raw), "
        f"cells AS (FROM numbered UNPIVOT INCLUDE NULLS (cell FOR field IN ({', '.join(map(q, K.EVENT_CONTRACT))}))), "
        "read AS (SELECT line, _row_id, field, kind, cell, "
        "CASE WHEN kind IN ('number', 'key') THEN TRY_CAST(trim(cell) AS DOUBLE) END AS found, "
        "CASE WHEN trim(cell) > '' THEN trim(cell) ELSE 'Unknown' END AS label "
        "FROM cells JOIN kinds USING (field)), "
        "ruled AS (SELECT *, nullif(found, CAST('NaN' AS DOUBLE)) AS amount FROM read), "
        f"typed AS (SELECT max(_row_id) AS _row_id, {', '.join(columns)}, "
        f"max(TRY_STRPTIME(CASE WHEN field = 'BEGIN_DATE_TIME' THEN cell END, '%d-%b-%y %H:%M:%S')) AS event_ts, "
        f"CASE WHEN {known} = 0 THEN 'invalid_state' WHEN {below} > 0 THEN 'negative_value' END AS _reject_reason "
        "FROM ruled GROUP BY line)"
    )


EVENT_TS = "TRY_STRPTIME(\"BEGIN_DATE_TIME\", '%d-%b-%y %H:%M:%S')"
TYPED = f"{RAW}, {_typed()}"
CONTRACT = ", ".join(q(c) for c in K.SILVER_COLUMNS)
SILVER = (
    f"{TYPED}, silver AS (SELECT {CONTRACT}, min(_row_id) AS _row_id, count(*) AS _copies "
    f"FROM typed WHERE _reject_reason IS NULL GROUP BY {CONTRACT})"
)


def half_even(expression: str, digits: int = 0) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"round_even({expression} * {scale}, 0) / {scale}"


def quantile(table: str, column: str, share: str, where: str = "true") -> str:
    """Linear interpolation between order statistics, blended from the nearer end."""
    return (
        "(SELECT CASE WHEN p - floor(p) < 0.5 THEN lo + (hi - lo) * (p - floor(p)) "
        "ELSE hi - (hi - lo) * (1 - (p - floor(p))) END FROM (SELECT p, "
        "max(CASE WHEN i = floor(p) THEN x END) AS lo, max(CASE WHEN i = ceil(p) THEN x END) AS hi "
        f"FROM (SELECT {column} AS x, row_number() OVER (ORDER BY {column}) - 1 AS i, "
        f"CAST({share} AS DOUBLE) * (count(*) OVER () - 1) AS p FROM {table} "
        f"WHERE {column} IS NOT NULL AND {where}) GROUP BY p))"
    )


def pct_rank(column: str) -> str:
    return (
        f"(rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / "
        f"CAST(2 AS DOUBLE)) / count(*) OVER ()"
    )


def _rollup() -> str:
    parts = [f"{q(K.KEY)}"]
    for c in (K.NAME, K.STATE, K.OWNERSHIP, K.REGION, K.COUNTIES):
        parts.append(f"arg_min({q(c)}, _row_id) AS {q(c)}")
    parts += [f"max({q(c)}) AS {q(c)}" for c in K.RELIABILITY]
    for c in K.DAMAGE:
        parts.append(f"sum({q(c)}) AS {q(K.RENAMED_SUMS[c])}")
    parts += [f"sum({q(c)}) AS {q(c)}" for c in K.HARM]
    parts += [
        f"count({q(K.EVENT_TYPE)}) AS {K.EVENT_COUNT}",
        f"count(DISTINCT {q(K.MONTH)}) AS {K.MONTH_COUNT}",
        f"max({q(K.MAGNITUDE)}) AS {q(K.MAGNITUDE)}",
    ]
    parts += [f"max({filled(number(f))}) AS {q(f)}" for f in K.GOLD_FLAGS]
    return (
        f"{SILVER}, summed AS (SELECT {', '.join(parts)} FROM silver "
        f"WHERE {q(K.KEY)} IS NOT NULL GROUP BY {q(K.KEY)}), "
        f"rollup AS (SELECT *, total_property_damage_usd + total_crops_damage_usd "
        f"AS {K.TOTAL_DAMAGE} FROM summed)"
    )


ROLLUP = _rollup()
LOSS_SQL = (
    f"round_even({q(K.SAIDI)} / CAST(60 AS DOUBLE) * greatest({q(K.COUNTIES)}, CAST(1 AS DOUBLE)) "
    "* CAST(50000 AS DOUBLE) * CAST(27 AS DOUBLE), 0)"
)
MARGIN_SQL = half_even(f"({q(K.SAIDI)} - CAST(150 AS DOUBLE))", 1)
GOLD = (
    f"{ROLLUP}, ranked AS (SELECT *, {pct_rank(q(K.SAIDI))} AS saidi_rank_pct, "
    f"{pct_rank(q(K.SAIFI))} AS saifi_rank_pct FROM rollup), "
    "scored AS (SELECT *, (saidi_rank_pct + saifi_rank_pct) / CAST(2 AS DOUBLE) AS risk_score "
    "FROM ranked), "
    f"cuts AS (SELECT {quantile('scored', 'risk_score', '0.8')} AS q80, "
    f"{quantile('scored', 'risk_score', '0.5')} AS q50), "
    "gold AS (SELECT scored.*, CASE WHEN risk_score >= q80 THEN 'High Risk' "
    "WHEN risk_score >= q50 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category, "
    f"{LOSS_SQL} AS {K.LOSS}, "
    f"CAST({q(K.SAIDI)} > 150 AS INTEGER) AS {K.BREACH}, "
    f"{MARGIN_SQL} AS {K.MARGIN}, "
    f"round(ln(1 + {K.TOTAL_DAMAGE}), 9) AS {K.LOG_DAMAGE}, "
    f"INJURIES_DIRECT + CAST(10 AS DOUBLE) * DEATHS_DIRECT AS {K.HUMAN_IMPACT}, "
    f"CAST(risk_score >= q80 AS INTEGER) AS high_risk FROM scored, cuts)"
)
SAIDI, KEY, STATE, OWNERSHIP, REGION = (
    q(c) for c in (K.SAIDI, K.KEY, K.STATE, K.OWNERSHIP, K.REGION)
)
CHOSEN = (
    "Ownership = 'BUILDING' AND \"NERC Region\" = 'ASIA' "
    "AND risk_category IN ('High Risk', 'Medium Risk')"
)


def on(prefix: str, body: str) -> str:
    return f"WITH {prefix} {body}"


# --- sources and sinks ------------------------------------------------------------------------


@check
def csv_landing() -> str:
    return on(RAW, 'SELECT "State" AS state, count(*) AS "rows", CAST(0 AS BIGINT) AS malformed, '
              "count(\"Utility Number\") AS keys, count(nullif(\"EVENT_TYPE\", '')) AS event_types "
              "FROM raw GROUP BY 1")


@check
def layered_run() -> str:
    return on(GOLD, "SELECT 'b1' AS batch_id, (SELECT count(*) FROM raw) AS bronze_rows, "
              "CAST(0 AS BIGINT) AS malformed_lines, "
              "(SELECT count(*) FROM typed WHERE _reject_reason IS NOT NULL) AS quarantined, "
              "(SELECT CAST(sum(_copies - 1) AS BIGINT) FROM silver) AS duplicates_removed, "
              "(SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM gold) AS utilities, "
              f"(SELECT count(DISTINCT {STATE}) FROM gold) AS states")


@check
def gated_run() -> str:
    sizes = {
        "bronze_outage_events": "SELECT count(*) FROM raw",
        "silver_outage_events": "SELECT count(*) FROM silver",
        "silver_quarantine": "SELECT count(*) FROM typed WHERE _reject_reason IS NOT NULL",
        "gold_utility_features": "SELECT count(*) FROM gold",
        "gold_state_risk_summary": f"SELECT count(DISTINCT {STATE}) FROM gold",
        "manifest": "SELECT CAST(1 AS BIGINT)",
    }
    return on(GOLD, " UNION ALL ".join(f"SELECT '{n}' AS \"table\", ({size}) AS \"rows\"" for n, size in sizes.items()))


@check
def bronze_lineage() -> str:
    return on(RAW, "SELECT 'b1' AS batch_id, '2024-01-01 00:00:00' AS ingested_at, count(*) AS \"rows\", "
              "count(*) AS row_ids, count(*) AS with_file FROM raw")


@check
def dev_limit() -> str:
    good = "least(1000, count(*) FILTER (WHERE c_acctbal >= 0))"
    return (f'SELECT {good} AS "rows", {good} AS row_ids, '
            "count(*) FILTER (WHERE c_acctbal < 0) AS rejected_lines FROM customer")


@check
def quoted_lines() -> str:
    return ("SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, md5(coalesce(text, '')) AS text_md5, "
            "CAST(length(nullif(text, '')) AS INTEGER) AS n_chars FROM documents")


@check
def malformed_lines() -> str:
    return ("SELECT count(*) FILTER (WHERE c_acctbal >= 0) AS good_lines, "
            "count(*) FILTER (WHERE c_acctbal < 0) AS rejected_lines FROM customer")


@check
def publish_counts() -> str:
    return ("SELECT CASE o_orderstatus WHEN 'F' THEN 'b1' WHEN 'O' THEN 'b2' ELSE 'b3' END AS batch_id, "
            "count(*) AS expected_rows, count(*) AS published_rows, true AS matches "
            "FROM orders GROUP BY 1")


@check
def snake_columns() -> str:
    return on(RAW, 'SELECT "State" AS state, "NERC Region" AS nerc_region, count(*) AS "rows", '
              "count(*) FILTER (WHERE \"SPP\" = 'Y') AS spp_yes, "
              "count(*) FILTER (WHERE \"SPP.1\" = '1') AS spp_1_yes FROM raw GROUP BY 1, 2")


# --- fixed values: the columns of lineitem, in file order
LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


@check
def table_fingerprint() -> str:
    cells = [f"CAST({c} AS VARCHAR)" for c in LINEITEM]
    row = " || ".join(f"coalesce(length({x}) || ':' || {x}, '-')" for x in cells)

    def total(first: int) -> str:
        digits = f"list_transform(string_split(substr(digest, {first}, 15), ''), lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS HUGEINT))"
        return f"CAST(sum(list_reduce({digits}, lambda a, b: a * 16 + b)) AS VARCHAR)"

    return (f"SELECT count(*) AS \"rows\", {total(1)} || '-' || {total(16)} AS fingerprint "
            f"FROM (SELECT md5({row}) AS digest FROM lineitem)")


# --- typing and cleaning ------------------------------------------------------------------------


@check
def exposure_join() -> str:
    return (f"SELECT n_name, l_returnflag, count(*) AS pairs, sum(l_quantity) AS quantity "
            f"FROM {JOINED} GROUP BY 1, 2")


@check
def exposure_join_spread() -> str:
    return (f"SELECT c_mktsegment, o_orderstatus, count(*) AS pairs, "
            "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents "
            "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")


@check
def coerce_numeric() -> str:
    return on(RAW, f"SELECT _row_id AS row_id, {filled(number(K.SAIDI))} AS saidi, "
              f"{filled(number(K.MAGNITUDE))} AS magnitude, "
              f"{filled(number(K.DAMAGE[1]))} AS crops FROM raw")


@check
def coerce_key() -> str:
    half = "TRY_CAST(trim(\"County_Count\") || '.5' AS DOUBLE)"
    return on(RAW, f"SELECT _row_id AS row_id, {whole_key(number(K.KEY))} AS utility_number, "
              f"{whole_key(half)} AS half_even FROM raw")


@check
def text_default() -> str:
    return on(RAW, f"SELECT _row_id AS row_id, {defaulted(K.OWNERSHIP)} AS ownership, "
              f"{defaulted(K.REGION)} AS region, {defaulted(K.EVENT_TYPE)} AS event_type FROM raw")


@check
def parse_event_time() -> str:
    return on(RAW, f"SELECT _row_id AS row_id, {EVENT_TS} AS event_ts FROM raw")


DAMAGE_TEXTS = f"texts AS (SELECT l_orderkey, l_linenumber, {feed.DAMAGE_TEXT} AS t FROM lineitem)"


@check
def loose_event_time() -> str:
    """The time each text was made from; nothing is parsed."""
    hour, minute, second = (f"CAST({part} AS BIGINT)" for part in feed.CLOCK)
    made = f"make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), {hour}, {minute}, CAST({second} AS DOUBLE))"
    return f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 2 THEN {made} END AS event_ts FROM orders"


@check
def parse_damage() -> str:
    bare = "upper(replace(replace(trim(t), '$', ''), ',', ''))"
    return on(
        f"{DAMAGE_TEXTS}, bare AS (SELECT *, {bare} AS b FROM texts)",
        "SELECT l_orderkey, l_linenumber, CASE "
        "WHEN trim(t) IN ('', 'nan', 'NaN', 'None', '--', 'N/A') THEN CAST(0 AS DOUBLE) "
        "ELSE coalesce(CASE right(b, 1) "
        "WHEN 'K' THEN TRY_CAST(left(b, -1) AS DOUBLE) * CAST(1000 AS DOUBLE) "
        "WHEN 'M' THEN TRY_CAST(left(b, -1) AS DOUBLE) * CAST(1000000 AS DOUBLE) "
        "WHEN 'B' THEN TRY_CAST(left(b, -1) AS DOUBLE) * CAST(1000000000 AS DOUBLE) "
        "ELSE TRY_CAST(b AS DOUBLE) END, CAST(0 AS DOUBLE)) END AS damage_usd FROM bare",
    )


@check
def safe_number() -> str:
    return on(DAMAGE_TEXTS, "SELECT l_orderkey, l_linenumber, "
              "coalesce(TRY_CAST(trim(t) AS DOUBLE), CAST(0 AS DOUBLE)) AS number FROM texts")


@check
def valid_state_filter() -> str:
    return on(RAW, f'SELECT "State" AS state, count(*) AS "rows" FROM raw '
              f'WHERE "State" IN ({listed(K.STATES)}) GROUP BY 1')


@check
def tolerant_clean() -> str:
    def known(c: str) -> str:
        return f"CASE WHEN {q(c)} NOT IN ({listed(MISSING_TOKENS)}) THEN {q(c)} END"

    def cell(c: str) -> str:
        if c in K.FLOAT_COLUMNS:
            return filled(number(c))
        if c == K.KEY:
            return whole_key(number(c))
        if c in K.DEFAULTED_TEXT:
            return f"trim(coalesce({known(c)}, 'Unknown'))"
        return known(c)

    cells = ", ".join(f"{cell(c)} AS {q(c)}" for c in K.EVENT_CONTRACT)
    return on(RAW, f'SELECT DISTINCT {cells} FROM raw WHERE "State" IN ({listed(K.STATES)})')


@check
def quarantine_rows() -> str:
    return on(TYPED, f"SELECT _row_id, _reject_reason, {CONTRACT} FROM typed "
              "WHERE _reject_reason IS NOT NULL")


@check
def silver_events() -> str:
    return on(TYPED, f"SELECT DISTINCT {CONTRACT} FROM typed WHERE _reject_reason IS NULL")


@check
def dedup_exact() -> str:
    return on(SILVER, f"SELECT {KEY} AS utility_number, MONTH_NAME AS month, count(*) AS events, "
              "CAST(sum(_copies) AS BIGINT) AS copies, min(_row_id) AS first_row "
              "FROM silver GROUP BY 1, 2")


# --- quality ----------------------------------------------------------------------------------


@check
def reject_counts() -> str:
    parts = [
        f"SELECT '{r}' AS reason, count(*) FILTER (WHERE _reject_reason = '{r}') AS \"rows\" "
        "FROM typed"
        for r in K.REJECT_REASONS
    ]
    return on(TYPED, " UNION ALL ".join(parts))


@check
def soft_profile() -> str:
    return on(TYPED, "SELECT field AS column_name, "
              "count(*) FILTER (WHERE isnan(found) OR coalesce(trim(cell), '') = '') AS null_or_nan, "
              "count(*) FILTER (WHERE found IS NULL AND trim(cell) > '') AS unparseable "
              "FROM read WHERE kind = 'number' GROUP BY field")


@check
def missing_keys() -> str:
    return on(RAW, f"SELECT count(*) FILTER (WHERE {number(K.KEY)} IS NULL) "
              "AS utility_number_missing FROM raw")


@check
def duplicate_count() -> str:
    return on(SILVER, "SELECT count(*) AS silver_rows, "
              "CAST(sum(_copies - 1) AS BIGINT) AS duplicates_removed FROM silver")


@check
def layer_identity() -> str:
    return on(SILVER, "SELECT (SELECT count(*) FROM raw) AS bronze_rows, "
              "(SELECT count(*) FROM typed WHERE _reject_reason IS NOT NULL) AS quarantined, "
              "(SELECT CAST(sum(_copies - 1) AS BIGINT) FROM silver) AS duplicates_removed, "
              "(SELECT count(*) FROM silver) AS silver_rows, true AS identity_holds")


@check
def quality_rate() -> str:
    return on(TYPED, "SELECT count(*) AS bronze_rows, count(_reject_reason) AS quarantined, "
              "CAST(100 AS DOUBLE) * count(_reject_reason) / greatest(count(*), 1) "
              "AS quarantine_pct, CAST(100 AS DOUBLE) * count(_reject_reason) / "
              "greatest(count(*), 1) <= 1 AS passes FROM typed")


@check
def table_parity() -> str:
    both = ("(SELECT * FROM orders) a JOIN (SELECT o_orderkey AS k, o_custkey AS c, "
            "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END "
            "AS p, o_orderdate AS d FROM orders WHERE o_orderstatus <> 'P') b ON o_orderkey = k")
    return (
        f"SELECT 'o_custkey' AS column_name, count(*) FILTER (WHERE o_custkey <> c) AS \"rows\" "
        f"FROM {both} UNION ALL SELECT 'o_totalprice', "
        f"count(*) FILTER (WHERE abs(o_totalprice - p) > 1e-9) FROM {both} UNION ALL "
        f"SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate <> d) FROM {both} UNION ALL "
        "SELECT '(left only)', count(*) FROM orders WHERE o_orderstatus = 'P' UNION ALL "
        "SELECT '(right only)', 0"
    )


@check
def table_parity_tree() -> str:
    return SQL["table_parity"]


@check
def exact_difference() -> str:
    columns = "l_suppkey, l_linenumber, l_returnflag, l_linestatus"
    return (f"SELECT {columns}, count(*) AS left_copies, CAST(1 AS BIGINT) AS right_copies "
            f"FROM lineitem GROUP BY {columns} HAVING count(*) <> 1")


# --- roll-up, ranks, scores -----------------------------------------------------------------------


@check
def utility_rollup_rows() -> str:
    return on(ROLLUP, "SELECT * FROM rollup")


@check
def avg_pct_rank() -> str:
    return (f"SELECT o_orderkey, {pct_rank('o_totalprice')} AS price_rank, "
            f"{pct_rank('o_custkey')} AS customer_rank FROM orders")


@check
def quantile_thresholds() -> str:
    parts = [f"{quantile('orders', 'o_totalprice', str(s / 100))} AS q{s}" for s in (50, 80, 90, 95)]
    return "SELECT " + ", ".join(parts)


@check
def grouped_quantiles() -> str:
    parts = []
    for flag in ("A", "N", "R"):
        cells = [
            f"{quantile('lineitem', 'l_extendedprice', s, f'''l_returnflag = '{flag}' ''')} AS q{i}"
            for i, s in enumerate(("0.25", "0.5", "0.75"), 1)
        ]
        parts.append(f"SELECT '{flag}' AS l_returnflag, {', '.join(cells)}")
    return " UNION ALL ".join(parts)


@check
def utility_features() -> str:
    return on(GOLD, "SELECT * FROM gold")


@check
def state_risk_summary() -> str:
    return on(GOLD, f"SELECT {STATE} AS state, count(*) AS utilities, "
              "CAST(sum(high_risk) AS BIGINT) AS high_risk_utilities, "
              "round(CAST(100 AS DOUBLE) * sum(high_risk) / count(*), 1) AS high_risk_pct "
              "FROM gold GROUP BY 1 ORDER BY 3 DESC, 2 DESC, 1")


# --- reports -----------------------------------------------------------------------------------------


@check
def kpi_row() -> str:
    high = "count(*) FILTER (WHERE risk_category = 'High Risk')"
    return on(
        GOLD,
        f"SELECT count(*) AS utilities, {high} AS high_risk, count(DISTINCT {STATE}) AS states, "
        f"avg({SAIDI}) AS avg_saidi, sum({K.LOSS}) AS annual_loss_usd, "
        f"CAST(sum({K.BREACH}) AS BIGINT) AS sla_breaches, "
        f"CAST(sum({K.EVENT_COUNT}) AS BIGINT) AS storm_events, "
        f"CAST(100 AS DOUBLE) * {high} / greatest(count(*), 1) AS high_risk_pct, "
        f"avg({SAIDI}) - (SELECT avg({SAIDI}) FROM gold) AS saidi_delta "
        f"FROM gold WHERE {CHOSEN}",
    )


@check
def top_findings() -> str:
    high = "WHERE risk_category = 'High Risk'"

    def lead(column: str) -> str:
        return f"FROM gold {high} GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1"

    return on(
        GOLD,
        f"SELECT (SELECT {STATE} {lead(STATE)}) AS top_state, "
        f"(SELECT count(*) {lead(STATE)}) AS top_state_high_risk, "
        f"(SELECT {OWNERSHIP} {lead(OWNERSHIP)}) AS top_ownership, "
        f"(SELECT {REGION} FROM gold GROUP BY {REGION} ORDER BY avg({SAIDI}) DESC, "
        f"{REGION} LIMIT 1) AS worst_region, "
        f"(SELECT sum({K.LOSS}) FROM gold) / CAST(1000000000 AS DOUBLE) AS loss_billion_usd",
    )


def _state_metrics() -> None:
    values = {
        "saidi": f"avg({SAIDI})",
        "highrisk": "CAST(100 AS DOUBLE) * count(*) FILTER (WHERE risk_category = 'High Risk') "
                    "/ count(*)",
        "damage": f"sum({K.TOTAL_DAMAGE}) / CAST(1000000000 AS DOUBLE)",
        "loss": f"sum({K.LOSS}) / CAST(1000000 AS DOUBLE)",
    }
    for name, value in values.items():
        SQL[f"state_metric_{name}"] = on(
            GOLD, f"SELECT {STATE} AS state, {value} AS value FROM gold GROUP BY 1"
        )


_state_metrics()


@check
def tier_mix() -> str:
    return on(GOLD, "SELECT risk_category AS tier, count(*) AS utilities, count(*) / "
              "(SELECT CAST(count(*) AS DOUBLE) FROM gold) * CAST(100 AS DOUBLE) AS pct "
              "FROM gold GROUP BY 1")


@check
def tier_by_ownership() -> str:
    return on(GOLD, "SELECT Ownership AS ownership, risk_category AS tier, count(*) AS utilities "
              "FROM gold WHERE Ownership IN (SELECT Ownership FROM gold GROUP BY 1 "
              "ORDER BY count(*) DESC, 1 LIMIT 3) GROUP BY 1, 2")


@check
def tier_quantiles() -> str:
    kept = (f"kept AS (SELECT risk_category AS tier, {SAIDI} AS x FROM gold WHERE {SAIDI} > 0 "
            f"AND {SAIDI} < {quantile('gold', SAIDI, '0.95')})")
    names = {"minimum": "0", "q25": "0.25", "median": "0.5", "q75": "0.75", "maximum": "1"}
    parts = []
    for tier in (K.HIGH, K.MEDIUM, K.LOW):
        inside = f"tier = '{tier}'"
        cells = ", ".join(f"{quantile('kept', 'x', s, inside)} AS {n}" for n, s in names.items())
        parts.append(f"SELECT '{tier}' AS tier, count(*) AS utilities, avg(x) AS mean, "
                     f"{cells} FROM kept WHERE {inside}")
    return on(f"{GOLD}, {kept}",
              f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE utilities > 0")


@check
def score_histogram() -> str:
    return on(
        f"{GOLD}, span AS (SELECT min(risk_score) AS lo, max(risk_score) AS hi FROM gold)",
        "SELECT risk_category AS tier, CAST(least(floor((risk_score - lo) / (hi - lo) * "
        "CAST(40 AS DOUBLE)), 39) AS INTEGER) AS bin, count(*) AS utilities, "
        "(SELECT q80 FROM cuts) AS high_line FROM gold, span GROUP BY 1, 2",
    )


def _scaled(column: str, alias: str) -> str:
    return (f"({column} - min({column}) OVER ()) / (max({column}) OVER () - "
            f"min({column}) OVER () + CAST(1e-9 AS DOUBLE)) AS {alias}")


@check
def region_heat() -> str:
    columns = ("avg_saidi", "pct_high", "avg_storms", "avg_loss_musd")
    return on(
        f"{GOLD}, means AS (SELECT {REGION} AS region, avg({SAIDI}) AS avg_saidi, "
        "sum(high_risk) / CAST(count(*) AS DOUBLE) AS pct_high, "
        f"sum({K.EVENT_COUNT}) / CAST(count(*) AS DOUBLE) AS avg_storms, "
        f"avg({K.LOSS}) / CAST(1000000 AS DOUBLE) AS avg_loss_musd FROM gold GROUP BY 1)",
        f"SELECT *, {', '.join(_scaled(c, c + '_scaled') for c in columns)} FROM means",
    )


@check
def region_radar() -> str:
    dims = {"saidi": SAIDI, "high_risk": "high_risk", "storm_events": K.EVENT_COUNT,
            "damage": K.TOTAL_DAMAGE, "human_impact": K.HUMAN_IMPACT}
    means = ", ".join(f"avg({c}) AS m_{n}" for n, c in dims.items())
    return on(f"{GOLD}, means AS (SELECT {REGION} AS region, {means} FROM gold GROUP BY 1)",
              f"SELECT region, {', '.join(_scaled('m_' + n, n) for n in dims)} FROM means")


def _top(column: str, k: int) -> str:
    return f"(SELECT {column} FROM gold GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {k})"


@check
def tier_by_state() -> str:
    return on(GOLD, f"SELECT {STATE} AS ownership, risk_category AS tier, count(*) AS utilities FROM gold "
              f"WHERE {STATE} IN {_top(STATE, 6)} GROUP BY 1, 2")


@check
def state_heat() -> str:
    columns = ("avg_saidi", "pct_high", "avg_storms", "avg_loss_musd")
    return on(
        f"{GOLD}, means AS (SELECT {STATE} AS region, avg({SAIDI}) AS avg_saidi, "
        "sum(high_risk) / CAST(count(*) AS DOUBLE) AS pct_high, "
        f"sum({K.EVENT_COUNT}) / CAST(count(*) AS DOUBLE) AS avg_storms, "
        f"avg({K.LOSS}) / CAST(1000000 AS DOUBLE) AS avg_loss_musd FROM gold WHERE {STATE} IN {_top(STATE, 10)} GROUP BY 1)",
        f"SELECT *, {', '.join(_scaled(c, c + '_scaled') for c in columns)} FROM means",
    )


@check
def state_radar() -> str:
    dims = {"saidi": SAIDI, "high_risk": "high_risk", "storm_events": K.EVENT_COUNT,
            "damage": K.TOTAL_DAMAGE, "human_impact": K.HUMAN_IMPACT}
    means = ", ".join(f"avg({c}) AS m_{n}" for n, c in dims.items())
    return on(f"{GOLD}, means AS (SELECT {STATE} AS region, {means} FROM gold WHERE {STATE} IN {_top(STATE, 7)} GROUP BY 1)",
              f"SELECT region, {', '.join(_scaled('m_' + n, n) for n in dims)} FROM means")


@check
def report_panels() -> str:
    """Every additive table of the report, from the chosen utilities by plain grouping."""
    double, none = "CAST({} AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    high = "count(*) FILTER (WHERE risk_category = 'High Risk')"

    def long(panel: str, name: str, part: str, values: dict[str, str], source: str, group: str = "") -> list[str]:
        return [
            f"SELECT '{panel}' AS panel, {name} AS name, {part} AS part, '{metric}' AS metric, "
            f"{double.format(value)} AS value FROM {source} {group}" for metric, value in values.items()
        ]

    kpi = {
        "utilities": "count(*)", "high_risk": high, "states": f"count(DISTINCT {STATE})", "avg_saidi": f"avg({SAIDI})",
        "annual_loss_usd": f"sum({K.LOSS})", "sla_breaches": f"sum({K.BREACH})", "storm_events": f"sum({K.EVENT_COUNT})",
        "high_risk_pct": f"CAST(100 AS DOUBLE) * {high} / greatest(count(*), 1)",
        "saidi_delta": f"avg({SAIDI}) - (SELECT avg({SAIDI}) FROM gold)",
    }
    ahead = f"FROM chosen WHERE risk_category = 'High Risk' GROUP BY {STATE} ORDER BY count(*) DESC, {STATE} LIMIT 1"
    worst = f"(SELECT {REGION} FROM chosen GROUP BY {REGION} ORDER BY avg({SAIDI}) DESC, {REGION} LIMIT 1)"
    means = {
        "avg_saidi": f"avg({SAIDI})", "pct_high": "sum(high_risk) / CAST(count(*) AS DOUBLE)",
        "avg_storms": f"sum({K.EVENT_COUNT}) / CAST(count(*) AS DOUBLE)", "avg_loss_musd": f"avg({K.LOSS}) / CAST(1000000 AS DOUBLE)",
        "avg_saidi_scaled": f"(avg({SAIDI}) - min(avg({SAIDI})) OVER ()) / (max(avg({SAIDI})) OVER () - min(avg({SAIDI})) OVER () + CAST(1e-9 AS DOUBLE))",
    }
    radar = {
        n: f"(avg({c}) - min(avg({c})) OVER ()) / (max(avg({c})) OVER () - min(avg({c})) OVER () + CAST(1e-9 AS DOUBLE))"
        for n, c in (("saidi", SAIDI), ("damage", K.TOTAL_DAMAGE), ("human_impact", K.HUMAN_IMPACT))
    }
    parts = [
        *long("kpi", none, none, kpi, "chosen"),
        *long("findings", f"(SELECT {STATE} {ahead})", worst, {
            "top_state_high_risk": f"(SELECT count(*) {ahead})",
            "loss_billion_usd": f"(SELECT sum({K.LOSS}) FROM chosen) / CAST(1000000000 AS DOUBLE)",
        }, "(SELECT 1)"),
        *long("state_metric", STATE, none, {"value": f"avg({SAIDI})"}, "chosen", f"GROUP BY {STATE}"),
        *long("tier_mix", "risk_category", none, {
            "utilities": "count(*)", "pct": "count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM chosen) * CAST(100 AS DOUBLE)",
        }, "chosen", "GROUP BY risk_category"),
        *long("tier_by_ownership", OWNERSHIP, "risk_category", {"utilities": "count(*)"}, "chosen", f"GROUP BY {OWNERSHIP}, risk_category"),
        *long("region_heat", REGION, none, means, "chosen", f"GROUP BY {REGION}"),
        *long("region_radar", REGION, none, radar, "chosen", f"GROUP BY {REGION}"),
    ]
    top = f"SELECT {STATE} AS s, {high} AS n FROM chosen GROUP BY 1 HAVING {high} > 0 ORDER BY 2 DESC, 1 LIMIT 20"
    parts.append(f"SELECT 'top_states', s, {none}, 'high_risk', CAST(n AS DOUBLE) FROM ({top})")
    return on(f"{GOLD}, chosen AS (SELECT * FROM gold WHERE Ownership = 'BUILDING')", " UNION ALL ".join(parts))


@check
def bubble_points() -> str:
    return on(
        f"{GOLD}, kept AS (SELECT *, {K.LOSS} / CAST(1000000 AS DOUBLE) AS loss_musd FROM gold "
        f"WHERE {SAIDI} > 0 AND {K.EVENT_COUNT} > 0 AND {K.LOSS} > 0)",
        f"SELECT {KEY} AS utility_number, risk_category AS tier, {K.EVENT_COUNT} AS storm_events, "
        f"{SAIDI} AS saidi, loss_musd, least(greatest(loss_musd / (SELECT max(loss_musd) FROM kept) "
        "* CAST(40 AS DOUBLE) + CAST(5 AS DOUBLE), CAST(4 AS DOUBLE)), CAST(45 AS DOUBLE)) AS size, "
        "\"Utility Name\" || ' | State: ' || \"State\" || ' | SAIDI: ' || "
        f"CAST({half_even(SAIDI, 1)} AS VARCHAR) || ' min/yr | Loss: $' || "
        f"CAST({half_even('loss_musd', 1)} AS VARCHAR) || 'M' AS hover FROM kept",
    )


@check
def filtered_report() -> str:
    return on(GOLD, f"SELECT {KEY} AS utility_number, risk_category, risk_score FROM gold "
              f"WHERE {CHOSEN}")


@check
def filter_fallback() -> str:
    return on(GOLD, f"SELECT {STATE} AS state, count(*) AS utilities FROM gold GROUP BY 1")


@check
def ranking_table() -> str:
    shown = {
        K.SCORE: half_even("risk_score", 4),
        K.SAIDI: half_even(SAIDI, 1),
        K.LOSS: half_even(f"({K.LOSS} / CAST(1000000 AS DOUBLE))", 1),
    }
    cells = [f"{shown.get(c, q(c))} AS {q(title)}" for c, title in RANKING_NAMES.items()]
    return on(GOLD, f"SELECT {', '.join(cells)} FROM gold")


@check
def top_loss() -> str:
    return on(
        GOLD,
        "SELECT substr(\"Utility Name\", 1, 24) || ' (' || \"State\" || ')' AS label, "
        f"risk_category AS tier, {half_even(f'({K.LOSS} / CAST(1000000 AS DOUBLE))', 1)} AS loss_musd "
        f"FROM (SELECT * FROM gold WHERE {K.LOSS} > 0 ORDER BY {K.LOSS} DESC, {KEY} LIMIT 20)",
    )


@check
def top_states() -> str:
    return on(GOLD, f"SELECT {STATE} AS state, count(*) AS high_risk FROM gold "
              "WHERE risk_category = 'High Risk' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")


@check
def compare_two() -> str:
    parts = []
    for label, (column, divisor) in COMPARED.items():
        value = half_even(f"(CAST({q(column)} AS DOUBLE) / CAST({divisor:.0f} AS DOUBLE))", 3)
        names = 'SELECT DISTINCT "Utility Name" FROM gold WHERE "Utility Name" IS NOT NULL ORDER BY 1'
        cells = ", ".join(
            f"(SELECT {value} FROM gold WHERE \"Utility Name\" = "
            f"({names} LIMIT 1 OFFSET {at}) ORDER BY {KEY} LIMIT 1) AS {side}"
            for at, side in enumerate(("first", "second"))
        )
        parts.append(f"SELECT '{label}' AS metric, {cells}")
    return on(GOLD, f"SELECT * FROM ({' UNION ALL '.join(parts)}) "
              "WHERE first IS NOT NULL AND second IS NOT NULL")


@check
def value_list_states() -> str:
    return on(GOLD, f"SELECT DISTINCT {STATE} AS value FROM gold WHERE {STATE} IS NOT NULL")


@check
def value_list_names() -> str:
    return on(GOLD, 'SELECT DISTINCT "Utility Name" AS value FROM gold '
              'WHERE "Utility Name" IS NOT NULL ORDER BY 1 LIMIT 300')


@check
def centroid_lookup() -> str:
    rows = ", ".join(f"('{s}', {lat}, {lon})" for s, (lat, lon) in STATE_CENTROIDS.items())
    lat, lon = DEFAULT_CENTROID
    return on(
        f"{GOLD}, centroids(s, la, lo) AS (VALUES {rows})",
        f"SELECT {KEY} AS utility_number, \"State\", CAST(coalesce(la, {lat}) AS DOUBLE) AS lat, "
        f"CAST(coalesce(lo, {lon}) AS DOUBLE) AS lon FROM gold LEFT JOIN centroids ON \"State\" = s",
    )


@check
def absent_columns() -> str:
    return on(GOLD, f"SELECT {STATE} AS state, count(*) AS utilities, CAST(0 AS BIGINT) AS loss, "
              "CAST(0 AS BIGINT) AS breaches, count(risk_score) AS scores FROM gold GROUP BY 1")


# --- learning ----------------------------------------------------------------------------------------


@check
def label_balance() -> str:
    return on(GOLD, 'SELECT high_risk AS label, count(*) AS "rows", count(*) / '
              "(SELECT CAST(count(*) AS DOUBLE) FROM gold) * CAST(100 AS DOUBLE) AS pct "
              "FROM gold GROUP BY 1")


@check
def relabel_thresholds() -> str:
    parts = [
        f"SELECT CAST(risk_score >= {quantile('gold', 'risk_score', share)} AS INTEGER) AS label, "
        f'count(*) AS "rows", {pct} AS top_pct FROM gold GROUP BY 1'
        for share, pct in (("0.9", 10), ("0.8", 20))
    ]
    return on(GOLD, " UNION ALL ".join(parts))


@check
def balanced_weights() -> str:
    return on(GOLD, 'SELECT high_risk AS label, (SELECT count(*) FROM gold) / '
              '(CAST(2 AS DOUBLE) * count(*)) AS weight, count(*) AS "rows" FROM gold GROUP BY 1')


@check
def stratified_split() -> str:
    sizes = ("sizes AS (SELECT high_risk AS label, count(*) AS n, "
             "CAST(floor(CAST(0.2 AS DOUBLE) * (count(*) - 1)) AS BIGINT) + 1 AS t FROM gold GROUP BY 1)")
    return on(f"{GOLD}, {sizes}",
              'SELECT label, true AS is_test, t AS "rows" FROM sizes UNION ALL '
              "SELECT label, false, n - t FROM sizes")


POINTS = (
    "judged AS (SELECT CAST(n_chars AS DOUBLE) AS score, quality AS y FROM documents "
    "JOIN labels USING (doc_id)), counts AS (SELECT score, "
    "count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg "
    "FROM judged GROUP BY 1), points AS (SELECT *, "
    "CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp, "
    "CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp, "
    "CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM counts)"
)


@check
def binary_metrics() -> str:
    tp = "sum(CASE WHEN score >= 1000 THEN pos ELSE 0 END)"
    fp = "sum(CASE WHEN score >= 1000 THEN neg ELSE 0 END)"
    return on(
        POINTS,
        "SELECT round(sum(pos * (n - fp + neg / CAST(2 AS DOUBLE))) / (max(p) * "
        "CAST(max(n) AS DOUBLE)), 9) AS roc_auc, "
        "round(sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / max(p), 9) AS pr_auc, "
        f"round(CAST(2 AS DOUBLE) * {tp} / ({tp} + {fp} + max(p)), 9) AS f1, "
        f"round({tp} / CAST({tp} + {fp} AS DOUBLE), 9) AS precision, "
        f"round({tp} / CAST(max(p) AS DOUBLE), 9) AS recall, "
        'max(p) AS positives, max(p) + max(n) AS "rows" FROM points',
    )


@check
def precision_recall_curve() -> str:
    return on(POINTS, "SELECT score, tp, fp, tp / CAST(tp + fp AS DOUBLE) AS precision, "
              "tp / CAST(p AS DOUBLE) AS recall FROM points")


@check
def confidence_bands() -> str:
    share = "printf('%.2f%%', risk_score * 100)"
    return on(
        GOLD,
        f"SELECT {KEY} AS utility_number, CASE WHEN risk_score >= 0.5 THEN 'High Risk' "
        "ELSE 'Medium/Low Risk' END AS risk_label, "
        f"{half_even('risk_score', 4)} AS risk_probability, CASE "
        "WHEN risk_score >= 0.75 OR risk_score <= 0.25 THEN 'High' "
        "WHEN risk_score >= 0.60 OR risk_score <= 0.40 THEN 'Medium' ELSE 'Low' END AS confidence, "
        "CASE WHEN risk_score >= 0.5 THEN 'Utility flagged as HIGH RISK (probability: ' || "
        f"{share} || '). Recommend infrastructure review.' ELSE "
        f"'Utility classified as lower risk (probability: ' || {share} || "
        "'). Monitor storm exposure.' END AS message FROM gold",
    )


@check
def scoring_features() -> str:
    return on(
        GOLD,
        f"SELECT {KEY} AS utility_number, {K.TOTAL_DAMAGE} AS total_property_damage_usd, "
        f"{K.TOTAL_DAMAGE} * CAST(0.1 AS DOUBLE) AS total_crops_damage_usd, "
        f"round(ln(1 + {K.TOTAL_DAMAGE}), 9) AS {K.LOG_DAMAGE}, "
        "INJURIES_DIRECT * CAST(0.5 AS DOUBLE) AS INJURIES_INDIRECT, "
        "DEATHS_DIRECT * CAST(0.5 AS DOUBLE) AS DEATHS_INDIRECT, "
        f"{K.HUMAN_IMPACT}, CAST(1 AS DOUBLE) AS County_Count, \"SERC\", 0 AS \"TRE\", "
        f"0 AS \"CAISO\", 'Cooperative' AS \"Ownership\", {REGION} AS region FROM gold",
    )


def all_sql() -> dict[str, str]:
    return dict(SQL)
