"""Column contract, value lists and constants that fix the meaning of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the event contract, in file order -------------------------
KEY = "Utility Number"
NAME, STATE, OWNERSHIP, REGION = "Utility Name", "State", "Ownership", "NERC Region"
REGION_FLAGS = (
    "TRE", "FRCC", "MRO", "NPCC", "RFC", "SERC", "SPP", "WECC", "CAISO", "ERCOT",
    "PJM", "NYISO", "SPP.1", "MISO", "ISONE",
)
COUNTIES = "County_Count"
SAIDI = "IEEE_AllEvents_SAIDI_min_per_yr"
SAIFI = "IEEE_AllEvents_SAIFI_times_per_yr"
RELIABILITY = (
    SAIDI,
    SAIFI,
    "IEEE_AllEvents_CAIDI_min_per_interruption",
    "IEEE_NoMED_SAIDI_min_per_yr",
    "IEEE_NoMED_SAIFI_times_per_yr",
    "IEEE_NoMED_CAIDI_min_per_interruption",
)
EVENT_TYPE, MONTH, MAGNITUDE = "EVENT_TYPE", "MONTH_NAME", "MAGNITUDE"
DAMAGE = ("DAMAGE_PROPERTY_USD", "DAMAGE_CROPS_USD")
HARM = ("INJURIES_DIRECT", "INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT")
EVENT_TIME_TEXT = "BEGIN_DATE_TIME"
EVENT_TS = "event_ts"

EVENT_CONTRACT = (
    KEY, NAME, STATE, OWNERSHIP, REGION, *REGION_FLAGS, COUNTIES, *RELIABILITY,
    EVENT_TYPE, MONTH, MAGNITUDE, *DAMAGE, *HARM, EVENT_TIME_TEXT,
)

# --- fixed values: the 50 states (no DC, no territories) ----------------------
STATES = tuple(
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO "
    "MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split()
)

# --- fixed values: month names, each a bit of a utility's set of months; others are counted as text
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December", "Unknown",
)

# --- fixed values: thresholds, weights and names ------------------------------
UNKNOWN = "Unknown"
INVALID_STATE, NEGATIVE_VALUE = "invalid_state", "negative_value"
REJECT_REASONS = (INVALID_STATE, NEGATIVE_VALUE)
EVENT_TIME_FORMAT = "d-MMM-yy H:mm:ss"
HIGH, MEDIUM, LOW = "High Risk", "Medium Risk", "Low Risk"
HIGH_QUANTILE, MEDIUM_QUANTILE = 0.80, 0.50
USD_PER_CUSTOMER_HOUR = 27.0
CUSTOMERS_PER_COUNTY = 50000.0
SLA_MINUTES = 150.0
DEATH_WEIGHT = 10.0
MAX_QUARANTINE_PCT = 1.0

# --- column roles derived from the contract -----------------------------------
FLOAT_COLUMNS = (COUNTIES, *RELIABILITY, MAGNITUDE, *DAMAGE, *HARM)
NON_NEGATIVE_COLUMNS = (*RELIABILITY, *DAMAGE, *HARM)
DEFAULTED_TEXT = (OWNERSHIP, REGION, EVENT_TYPE, MONTH)
GOLD_FLAGS = tuple(f for f in REGION_FLAGS if f != "SPP.1")
SILVER_COLUMNS = (*EVENT_CONTRACT, EVENT_TS)

# lineage that rides along with the layers but is not part of the event contract
ROW_ID, REJECT_REASON, COPIES = "_row_id", "_reject_reason", "_copies"
LINEAGE = ("_batch_id", "_ingested_at", "_source_file", ROW_ID)

# Gold columns that the roll-up renames
RENAMED_SUMS = {
    "DAMAGE_PROPERTY_USD": "total_property_damage_usd",
    "DAMAGE_CROPS_USD": "total_crops_damage_usd",
}
EVENT_COUNT, MONTH_COUNT, TOTAL_DAMAGE = (
    "weather_event_count", "months_with_events", "total_damage_usd")
SAIDI_RANK, SAIFI_RANK, SCORE, TIER, LABEL = (
    "saidi_rank_pct", "saifi_rank_pct", "risk_score", "risk_category", "high_risk")
LOSS, BREACH, MARGIN = (
    "estimated_annual_loss_usd", "nerc_sla_breach_risk", "sla_breach_margin_min")
LOG_DAMAGE, HUMAN_IMPACT = "log_total_damage", "human_impact_score"

# Everything the label is made of, or that is a function of it: never a model input.
LABEL_DERIVED = (
    LABEL, SCORE, TIER, SAIDI_RANK, SAIFI_RANK, LOSS, BREACH, MARGIN, *RELIABILITY,
)
IDENTITY = (KEY, NAME, STATE, OWNERSHIP, REGION, COUNTIES)
# Storm exposure columns, present only in the wide feature set.
STORM_FEATURES = (
    TOTAL_DAMAGE, *RENAMED_SUMS.values(), LOG_DAMAGE, "total_injuries", HUMAN_IMPACT,
    *HARM, MAGNITUDE, EVENT_COUNT, MONTH_COUNT,
)


class ContractError(Exception):
    """Required columns are missing, or a layer's row counts do not add up."""


class DataQualityError(RuntimeError):
    """Too many rows of a batch were quarantined for it to be promoted."""


def silver_schema() -> T.StructType:
    """The 38-field Silver schema."""

    def kind(name: str) -> T.DataType:
        if name in FLOAT_COLUMNS:
            return T.DoubleType()
        if name == KEY:
            return T.LongType()
        return T.TimestampType() if name == EVENT_TS else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in SILVER_COLUMNS])


def ident(name: str) -> str:
    """Quote a column name that may hold dots or spaces."""
    return "`" + name.replace("`", "``") + "`"
