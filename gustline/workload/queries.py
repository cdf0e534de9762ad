"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contract as K
from ..functions import scalars as S
from ..operators import clean as C
from ..operators import joins as J
from ..operators import learning as M
from ..operators import quality as Q
from ..operators import ranking as W
from ..operators import reports as R
from ..operators import scoring
from ..operators.rollup import utility_rollup
from ..plans.features import build_features
from ..plans.layered import run_gated, run_layers
from ..plans.report import report_tables
from ..session import freed_shuffles, stage, staged_path, staging_root, tune
from ..sources import layers as L
from ..sources import publish as P
from ..sources.delimited import export_csv, read_text_columns
from ..sources.manifest import manifest_table
from . import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# --- shared inputs ------------------------------------------------------------


_layers: dict[tuple[str, str, str], str] = {}


def _stored(
    name: str, build: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str
) -> DataFrame:
    """A layer table: written once per application, then read by every later query."""
    path = _found(name, spark, sf_dir)
    if path is None:
        path = _layers[staging_root(spark), sf_dir, name] = staged_path(spark, name)
        with freed_shuffles(spark):
            L.write_table(build(spark, sf_dir), path)
    return spark.read.parquet(path)


def _found(name: str, spark: SparkSession, sf_dir: str) -> str | None:
    """Where a layer table lies, if this application has stored it."""
    path = _layers.get((staging_root(spark), sf_dir, name))
    return path if path is not None and L.path_exists(spark, f"{path}/_SUCCESS") else None


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored("bronze", feed.raw_events, spark, sf_dir)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows for one pass: read if Bronze is stored, but not stored for it."""
    stored = _found("bronze", spark, sf_dir)
    return feed.raw_events(spark, sf_dir) if stored is None else spark.read.parquet(stored)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.typed_events(bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.silver_events(typed(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(silver(spark, sf_dir))


def _gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(C.silver_events(C.typed_events(_events(spark, sf_dir))))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored("gold", _gold_rows, spark, sf_dir)


# --- sources and sinks ----------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}"


@query
def csv_landing(spark, sf_dir):
    """Feed written as CSV, read back as text with line checks, landed, counted per state."""
    raw = bronze(spark, sf_dir).drop(K.ROW_ID)
    lines = read_text_columns(spark, export_csv(raw, _scratch(spark, "feed-csv")))
    landed = L.with_lineage(lines, "b1", "2024-01-01 00:00:00")
    return (
        landed.groupBy(F.col(K.STATE).alias("state"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("_corrupt").alias("malformed"),
            F.count(K.ident(K.KEY)).alias("keys"),
            F.count(K.EVENT_TYPE).alias("event_types"),
        )
    )


#: Event rows of a packed CSV file at most: some 4 MB of it, 40 MB of lines.
CSV_ROWS = 250_000


def _feed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The feed as packed CSV files, which the caller removes."""
    return export_csv(_events(spark, sf_dir).drop(K.ROW_ID), staged_path(spark, "feed-csv"), CSV_ROWS)


@query
def layered_run(spark, sf_dir):
    """The feed as CSV through the whole layered run: the manifest's counts."""
    raw = _feed_csv(spark, sf_dir)
    manifest = run_layers(
        spark, raw, staged_path(spark, "layers"), "b1", on_landed=partial(L.remove_path, spark, raw),
    )
    return manifest_table(spark, manifest).select(
        "batch_id", "bronze_rows", "malformed_lines", "quarantined", "duplicates_removed",
        "silver_rows", "utilities", "states",
    )


@query
def gated_run(spark, sf_dir):
    """The gated run, published: rows of every published table against the manifest."""
    target = staged_path(spark, "published")
    raw = _feed_csv(spark, sf_dir)
    manifest = run_gated(
        spark, raw, staged_path(spark, "layers"),
        max_quarantine_pct=100.0, publish_to=target, on_landed=partial(L.remove_path, spark, raw),
    )
    counted = [
        spark.read.parquet(info["location"]).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table"), "rows")
        for name, info in manifest["published"]["tables"].items()
    ]
    stored = spark.read.parquet(f"{target}/manifest").select(F.lit("manifest").alias("table"), F.lit(1).cast("bigint").alias("rows"))
    return reduce(DataFrame.union, [*counted, stored])


@query
def bronze_lineage(spark, sf_dir):
    """The landed feed: rows, distinct row ids and source files' rows per batch."""
    data = staged_path(spark, "layers")
    raw = _feed_csv(spark, sf_dir)
    L.land_bronze(spark, raw, data, "b1", "2024-01-01 00:00:00")
    L.remove_path(spark, raw)
    landed = L.read_batch(spark, data, L.BRONZE, L.EVENTS, "b1")
    return landed.groupBy("_batch_id", "_ingested_at").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(K.ROW_ID).alias("row_ids"),
        F.count("_source_file").alias("with_file"),
    ).select(
        F.col("_batch_id").alias("batch_id"), F.col("_ingested_at").cast("string").alias("ingested_at"),
        "rows", "row_ids", "with_file",
    )


@query
def dev_limit(spark, sf_dir):
    """A thousand good lines landed of a ragged file, with all of its bad lines counted and kept."""
    data, path = staged_path(spark, "layers"), staged_path(spark, "ragged-csv")
    _ragged_customers(spark, sf_dir).write.option("header", True).option("sep", "\u0001").csv(path)
    L.land_bronze(spark, path, data, "b1", "2024-01-01 00:00:00", limit=1000)
    landed = L.read_batch(spark, data, L.BRONZE, L.EVENTS, "b1")
    kept = L.read_batch(spark, data, L.BRONZE, L.REJECTED_LINES, "b1")
    return landed.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(K.ROW_ID).alias("row_ids")).withColumn(
        "rejected_lines", kept.agg(F.count("line")).scalar()
    )


@query
def quoted_lines(spark, sf_dir):
    """All documents, with their line breaks and quotes, through a CSV file."""
    docs = feed.tables(spark, sf_dir)("documents").select(F.col("doc_id").cast("string"), "lang", "text")
    lines = read_text_columns(spark, export_csv(docs, staged_path(spark, "quoted-csv")))
    return lines.filter("_corrupt IS NULL").select(
        "doc_id", "lang", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), F.length("text").alias("n_chars")
    )


def _ragged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer lines, with one field too many on some; the column's name is the header line."""
    customer = feed.tables(spark, sf_dir)("customer")
    return customer.select(
        F.expr(
            "c_custkey || ',' || c_name || ',' || c_mktsegment || "
            "CASE WHEN c_acctbal < 0 THEN ',x' ELSE '' END"
        ).alias("key,name,segment")
    )


@query
def malformed_lines(spark, sf_dir):
    """Customer list with one field too many on some lines: good and rejected lines."""
    # One text column; the separator never occurs.
    path = _scratch(spark, "ragged-csv")
    _ragged_customers(spark, sf_dir).write.mode("overwrite").option("header", True).option("sep", "\u0001").csv(path)
    lines = read_text_columns(spark, path)
    return lines.agg(
        F.count(F.when(F.col("_corrupt").isNull(), F.col("key"))).alias("good_lines"),
        F.count("_corrupt").alias("rejected_lines"),
    )


@query
def publish_counts(spark, sf_dir):
    """All orders in batches by status, two of them published twice; rows per batch."""
    location = _scratch(spark, "published/orders")
    orders = P.snake_columns(feed.tables(spark, sf_dir)("orders"))
    of = F.when(F.col("o_orderstatus") == "F", "b1").when(F.col("o_orderstatus") == "O", "b2")
    of = of.otherwise("b3")
    for batch in ("b1", "b2", "b3", "b1", "b2"):
        P.publish_table(orders.filter(of == batch), location, batch)
    expected = (
        orders.groupBy(of.alias("batch_id"))
        .agg(F.count(F.lit(1)).alias("expected_rows"))
    )
    return Q.reconcile_counts(spark.read.parquet(location), expected)


@query
def snake_columns(spark, sf_dir):
    """Feed under catalog-ready names, counted per state and region."""
    return (
        P.snake_columns(bronze(spark, sf_dir))
        .groupBy("state", "nerc_region")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when(F.col("spp") == "Y", 1)).alias("spp_yes"),
            F.count(F.when(F.col("spp_1") == "1", 1)).alias("spp_1_yes"),
        )
    )


@query
def table_fingerprint(spark, sf_dir):
    return Q.table_fingerprint(feed.tables(spark, sf_dir)("lineitem"))


# --- typing and cleaning ----------------------------------------------------------


@query
def exposure_join(spark, sf_dir):
    """Every (utility, event) pair, rolled up per state name and return flag."""
    return (
        feed.exposure(spark, sf_dir)
        .groupBy("n_name", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("pairs"), F.sum("l_quantity").alias("quantity"))
    )


@query
def exposure_join_spread(spark, sf_dir):
    """The same join with each hot key spread over eight reducers."""
    read = feed.tables(spark, sf_dir)
    orders = read("orders").withColumnRenamed("o_custkey", "custkey")
    customer = read("customer").withColumnRenamed("c_custkey", "custkey")
    return (
        J.exposure_join(customer, orders, ["custkey"], spread=8)
        .groupBy("c_mktsegment", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("pairs"),
             F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents"))
    )


def _row_values(spark, sf_dir, **columns):
    raw = bronze(spark, sf_dir)
    return raw.select(F.col(K.ROW_ID).alias("row_id"), *[v.alias(n) for n, v in columns.items()])


@query
def coerce_numeric(spark, sf_dir):
    return _row_values(
        spark, sf_dir, saidi=S.coerced(F.col(K.SAIDI)), magnitude=S.coerced(F.col(K.MAGNITUDE)),
        crops=S.coerced(F.col(K.DAMAGE[1])),
    )


@query
def coerce_key(spark, sf_dir):
    return _row_values(
        spark, sf_dir, utility_number=S.integer_key(F.col(K.ident(K.KEY))),
        half_even=S.integer_key(F.concat(F.trim(F.col(K.COUNTIES)), F.lit(".5"))),
    )


@query
def text_default(spark, sf_dir):
    return _row_values(
        spark, sf_dir, ownership=S.text_or_unknown(F.col(K.OWNERSHIP)),
        region=S.text_or_unknown(F.col(K.ident(K.REGION))),
        event_type=S.text_or_unknown(F.col(K.EVENT_TYPE)),
    )


@query
def parse_event_time(spark, sf_dir):
    return _row_values(spark, sf_dir, event_ts=S.event_time(F.col(K.EVENT_TIME_TEXT)))


@query
def loose_event_time(spark, sf_dir):
    """Times written with blanks around them, one-digit parts and several blanks, one for each order."""
    orders = feed.tables(spark, sf_dir)("orders")
    return orders.select("o_orderkey", S.event_time(F.expr(feed.LOOSE_TIME)).alias("event_ts"))


@query
def parse_damage(spark, sf_dir):
    return feed.damage_texts(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", S.damage_usd(F.col("damage_text")).alias("damage_usd")
    )


@query
def safe_number(spark, sf_dir):
    return feed.damage_texts(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", S.safe_number(F.col("damage_text")).alias("number")
    )


@query
def valid_state_filter(spark, sf_dir):
    raw = bronze(spark, sf_dir)
    return (
        raw.filter(F.col(K.STATE).isin(*K.STATES))
        .groupBy(F.col(K.STATE).alias("state"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def tolerant_clean(spark, sf_dir):
    """The one-step cleaner over the whole feed, all 37 columns."""
    return C.clean_tolerant(bronze(spark, sf_dir))


@query
def quarantine_rows(spark, sf_dir):
    """All rejected rows, all 40 columns."""
    return C.quarantined(typed(spark, sf_dir))


@query
def silver_events(spark, sf_dir):
    """Typed, validated, distinct events: the 38 contract columns."""
    return L.silver_contract(silver(spark, sf_dir))


@query
def dedup_exact(spark, sf_dir):
    """Distinct accepted events with copy count and first row, per key and month."""
    return (
        silver(spark, sf_dir)
        .groupBy(F.col(K.ident(K.KEY)).alias("utility_number"), F.col(K.MONTH).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(K.COPIES).alias("copies"),
            F.min(K.ROW_ID).alias("first_row"),
        )
    )


# --- quality -------------------------------------------------------------------------


@query
def reject_counts(spark, sf_dir):
    return Q.reject_counts(typed(spark, sf_dir))


@query
def soft_profile(spark, sf_dir):
    return Q.soft_profile(bronze(spark, sf_dir))


@query
def missing_keys(spark, sf_dir):
    return Q.missing_keys(bronze(spark, sf_dir))


@query
def duplicate_count(spark, sf_dir):
    return Q.duplicate_count(silver(spark, sf_dir))


@query
def layer_identity(spark, sf_dir):
    landed = bronze(spark, sf_dir)
    rows = C.typed_events(landed)
    return Q.layer_identity(landed, C.quarantined(rows), C.silver_events(rows))


@query
def quality_rate(spark, sf_dir):
    return Q.quality_rate(typed(spark, sf_dir))


def _repriced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and a version with repriced urgent orders and without the open ones."""
    orders = feed.tables(spark, sf_dir)("orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changed = orders.filter(F.col("o_orderstatus") != "P").withColumn(
        "o_totalprice", F.when(urgent, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    )
    return orders, changed


@query
def table_parity(spark, sf_dir):
    return Q.table_parity(*_repriced(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice", "o_orderdate"], 1e-9)


@query
def table_parity_tree(spark, sf_dir):
    """The same tables compared by a tree of hashes: only buckets that differ are joined."""
    return Q.parity_by_tree(*_repriced(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice", "o_orderdate"], 1e-9)


@query
def exact_difference(spark, sf_dir):
    """Rows whose copy count differs between the feed and its de-duplicated form."""
    lines = feed.tables(spark, sf_dir)("lineitem").select(
        "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    return Q.exact_difference(lines, lines.distinct())


# --- roll-up, ranks, scores --------------------------------------------------------------


@query
def utility_rollup_rows(spark, sf_dir):
    """One row per utility with all aggregates, straight from Silver."""
    return utility_rollup(silver(spark, sf_dir))


@query
def avg_pct_rank(spark, sf_dir):
    orders = feed.tables(spark, sf_dir)("orders")
    orders = orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double"))
    ranked = W.with_percent_rank(
        orders, {"price_rank": "o_totalprice", "customer_rank": "o_custkey"}, ["o_orderkey"]
    )
    return ranked.select("o_orderkey", "price_rank", "customer_rank")


@query
def quantile_thresholds(spark, sf_dir):
    orders = feed.tables(spark, sf_dir)("orders")
    shares = [0.5, 0.8, 0.9, 0.95]
    q = W.exact_quantiles(orders, "o_totalprice", shares)
    return q.select(*[F.col("q")[i].alias(f"q{int(s * 100)}") for i, s in enumerate(shares)])


@query
def grouped_quantiles(spark, sf_dir):
    lines = feed.tables(spark, sf_dir)("lineitem")
    q = W.exact_quantiles(lines, "l_extendedprice", [0.25, 0.5, 0.75], by=["l_returnflag"])
    return q.select("l_returnflag", *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])


@query
def utility_features(spark, sf_dir):
    """The whole Gold build: feed, Silver, roll-up, ranks, economics, tiers, label."""
    built = features(spark, sf_dir)
    return built.withColumn(K.LOG_DAMAGE, F.round(K.LOG_DAMAGE, 9))


@query
def state_risk_summary(spark, sf_dir):
    """Flagship: the Gold build down to one row per state."""
    return R.state_risk_summary(features(spark, sf_dir))


# --- reports on the stored Gold table --------------------------------------------------------

SOME_FILTER = {"ownership": "BUILDING", "region": "ASIA", "tiers": (K.HIGH, K.MEDIUM)}


@query
def kpi_row(spark, sf_dir):
    table = gold(spark, sf_dir)
    return R.kpi_row(R.filtered(table, **SOME_FILTER), table)


@query
def top_findings(spark, sf_dir):
    return R.top_findings(gold(spark, sf_dir))


def _state_metric(metric, spark, sf_dir):
    return R.state_metric(gold(spark, sf_dir), metric)


for _metric in R.STATE_METRICS:
    _registered = partial(_state_metric, _metric)
    _registered.__name__ = f"state_metric_{_metric}"
    query(_registered)


@query
def tier_mix(spark, sf_dir):
    return R.tier_mix(gold(spark, sf_dir))


@query
def tier_by_ownership(spark, sf_dir):
    return R.tier_by_ownership(gold(spark, sf_dir), 3)


@query
def tier_by_state(spark, sf_dir):
    """Tiers of the commonest states: a column with more values than the default number shown."""
    table = gold(spark, sf_dir).withColumn(K.OWNERSHIP, F.col(K.STATE))
    return R.tier_by_ownership(table)


@query
def state_heat(spark, sf_dir):
    return R.region_heat(gold(spark, sf_dir).withColumn(K.REGION, F.col(K.STATE)))


@query
def state_radar(spark, sf_dir):
    return R.region_radar(gold(spark, sf_dir).withColumn(K.REGION, F.col(K.STATE)))


@query
def report_panels(spark, sf_dir):
    """The whole report's additive tables, in long form, from its one cube."""
    tables = report_tables(gold(spark, sf_dir), ownership="BUILDING")

    def long(panel: str, name: str | None, *metrics: str, part: str | None = None) -> DataFrame:
        rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        text = [F.lit(None).cast("string") if c is None else F.col(c) for c in (name, part)]
        return tables[panel].select(F.lit(panel).alias("panel"), text[0].alias("name"), text[1].alias("part"), F.inline(F.array(*rows)))

    parts = [
        long("kpi", None, "utilities", "high_risk", "states", "avg_saidi", "annual_loss_usd", "sla_breaches", "storm_events", "high_risk_pct", "saidi_delta"),
        long("findings", "top_state", "top_state_high_risk", "loss_billion_usd", part="worst_region"),
        long("state_metric", "state", "value"),
        long("tier_mix", "tier", "utilities", "pct"),
        long("tier_by_ownership", "ownership", "utilities", part="tier"),
        long("region_heat", "region", "avg_saidi", "pct_high", "avg_storms", "avg_loss_musd", "avg_saidi_scaled"),
        long("region_radar", "region", "saidi", "damage", "human_impact"),
        long("top_states", "state", "high_risk"),
    ]
    return reduce(DataFrame.union, parts)


@query
def report_refresh(spark, sf_dir):
    """Rows of every table of the whole report."""
    tables = report_tables(gold(spark, sf_dir))
    return reduce(
        DataFrame.union,
        [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("report"), "rows") for n, t in tables.items()],
    )


@query
def tier_quantiles(spark, sf_dir):
    return R.tier_quantiles(gold(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return R.score_histogram(gold(spark, sf_dir))


@query
def region_heat(spark, sf_dir):
    return R.region_heat(gold(spark, sf_dir))


@query
def region_radar(spark, sf_dir):
    return R.region_radar(gold(spark, sf_dir))


@query
def bubble_points(spark, sf_dir):
    return R.bubble_points(gold(spark, sf_dir))


@query
def filtered_report(spark, sf_dir):
    chosen = R.filtered(gold(spark, sf_dir), **SOME_FILTER)
    return chosen.select(F.col(K.ident(K.KEY)).alias("utility_number"), K.TIER, K.SCORE)


@query
def filter_fallback(spark, sf_dir):
    """A filter that matches nothing shows every state."""
    chosen = R.filtered(gold(spark, sf_dir), state="ZZ")
    return chosen.groupBy(F.col(K.STATE).alias("state")).agg(F.count(F.lit(1)).alias("utilities"))


@query
def ranking_table(spark, sf_dir):
    return R.ranking_table(gold(spark, sf_dir))


@query
def top_loss(spark, sf_dir):
    return R.top_loss(gold(spark, sf_dir))


@query
def top_states(spark, sf_dir):
    return R.top_states(gold(spark, sf_dir))


@query
def compare_two(spark, sf_dir):
    """The first two utilities of the name list."""
    table = gold(spark, sf_dir)
    names = [row["value"] for row in R.value_list(table, K.NAME, 2).collect()]
    return R.compare_two(table, *names)


@query
def value_list_states(spark, sf_dir):
    return R.value_list(gold(spark, sf_dir), K.STATE)


@query
def value_list_names(spark, sf_dir):
    return R.value_list(gold(spark, sf_dir), K.NAME, 300)


@query
def centroid_lookup(spark, sf_dir):
    located = J.with_location(gold(spark, sf_dir))
    return located.select(F.col(K.ident(K.KEY)).alias("utility_number"), K.STATE, "lat", "lon")


@query
def centroid_jitter(spark, sf_dir):
    located = J.with_location(gold(spark, sf_dir), jitter_by=[K.KEY])
    return located.select(F.col(K.ident(K.KEY)).alias("utility_number"), "lat", "lon")


@query
def absent_columns(spark, sf_dir):
    """Guard columns added as 0 where a table lacks them."""
    table = gold(spark, sf_dir).drop(K.LOSS, K.BREACH)
    guarded = C.with_absent_columns(table, [K.LOSS, K.BREACH, K.SCORE])
    return guarded.groupBy(F.col(K.STATE).alias("state")).agg(
        F.count(F.lit(1)).alias("utilities"),
        F.sum(K.LOSS).alias("loss"),
        F.sum(K.BREACH).alias("breaches"),
        F.count(K.SCORE).alias("scores"),
    )


# --- learning --------------------------------------------------------------------------------


@query
def label_balance(spark, sf_dir):
    return R.label_balance(gold(spark, sf_dir))


@query
def relabel_thresholds(spark, sf_dir):
    table = gold(spark, sf_dir).select(K.SCORE)
    parts = []
    for share in M.TOP_SHARES:
        marked = M.relabelled(table, share)
        parts.append(
            marked.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("top_pct", F.lit(int(share * 100)))
        )
    return parts[0].unionByName(parts[1])


@query
def balanced_weights(spark, sf_dir):
    weighted = M.with_balanced_weight(gold(spark, sf_dir), K.LABEL)
    return weighted.groupBy(F.col(K.LABEL).alias("label"), "weight").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def stratified_split(spark, sf_dir):
    split = M.with_test_flag(gold(spark, sf_dir), [K.KEY], K.LABEL)
    return split.groupBy(F.col(K.LABEL).alias("label"), "is_test").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _judged(spark, sf_dir):
    read = feed.tables(spark, sf_dir)
    return read("documents").join(read("labels"), "doc_id").select(
        F.col("n_chars").cast("double").alias("score"), "quality"
    )


@query
def binary_metrics(spark, sf_dir):
    row = W.binary_metrics(_judged(spark, sf_dir), "score", "quality", 1000.0)
    names = ("roc_auc", "pr_auc", "f1", "precision", "recall")
    return row.select(*[F.round(n, 9).alias(n) for n in names], "positives", "rows")


@query
def precision_recall_curve(spark, sf_dir):
    points = W.precision_recall_points(_judged(spark, sf_dir), "score", "quality")
    return points.select("score", "tp", "fp", "precision", "recall")


@query
def confidence_bands(spark, sf_dir):
    """Verdicts for every utility, with the risk score standing in for a probability."""
    table = gold(spark, sf_dir)
    return table.select(
        F.col(K.ident(K.KEY)).alias("utility_number"),
        *[v.alias(n) for n, v in S.risk_verdict(F.col(K.SCORE)).items()],
    )


@query
def scoring_features(spark, sf_dir):
    """Model inputs derived by the serving rules from the request columns of every utility."""
    requests = gold(spark, sf_dir).select(
        K.ident(K.KEY), K.EVENT_COUNT, K.TOTAL_DAMAGE, "INJURIES_DIRECT", "DEATHS_DIRECT",
        K.MAGNITUDE, "SERC", F.col(K.ident(K.REGION)).alias("NERC_Region"),
    )
    made = scoring.derive_scoring_features(requests)
    return made.select(
        F.col(K.ident(K.KEY)).alias("utility_number"),
        "total_property_damage_usd", "total_crops_damage_usd",
        F.round(K.LOG_DAMAGE, 9).alias(K.LOG_DAMAGE), "INJURIES_INDIRECT", "DEATHS_INDIRECT",
        K.HUMAN_IMPACT, "County_Count", "SERC", "TRE", "CAISO", "Ownership",
        F.col(K.ident(K.REGION)).alias("region"),
    )


@query
def train_grid(spark, sf_dir):
    """Both feature sets, all five models at their default sizes, both labels."""
    return M.run_grid(gold(spark, sf_dir)).results


@query
def batch_score(spark, sf_dir):
    """Logistic regression at its default size, fitted on the training part, for the test part."""
    table = stage(M.with_test_flag(gold(spark, sf_dir), [K.KEY], K.LABEL), "split")
    spec = M.model_specs()["Logistic Regression"]
    wide = M.feature_sets(table)[M.WIDE]
    train = table.where("not is_test").withColumn("label", F.col(K.LABEL))
    model = M.fit_pipeline(train, spec, wide, list(M.CATEGORICAL))
    inputs = [K.ident(c) for c in (K.KEY, *wide, *M.CATEGORICAL)]
    scored = scoring.batch_score(model, table.where("is_test").select(*inputs))
    return scored.select(
        F.col(K.ident(K.KEY)).alias("utility_number"),
        "risk_label", "risk_probability", "confidence", "message",
    )


@query
def kmeans_profile(spark, sf_dir):
    located = J.with_location(gold(spark, sf_dir), jitter_by=[K.KEY])
    clustered, _ = M.fit_clusters(located, 6)
    return M.cluster_profile(clustered)
