"""Lookup, exposure and comparison joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import contract as K
from ..functions import scalars as S

# --- fixed values: state centroids (latitude, longitude) and the default point ---
STATE_CENTROIDS = {
    "AL": (32.81, -86.79), "AK": (61.37, -152.40), "AZ": (33.73, -111.43),
    "AR": (34.97, -92.37), "CA": (36.12, -119.68), "CO": (39.06, -105.31),
    "CT": (41.60, -72.76), "DE": (39.32, -75.51), "FL": (27.77, -81.69),
    "GA": (33.04, -83.64), "HI": (21.09, -157.50), "ID": (44.24, -114.48),
    "IL": (40.35, -88.99), "IN": (39.85, -86.26), "IA": (42.01, -93.21),
    "KS": (38.53, -96.73), "KY": (37.67, -84.67), "LA": (31.17, -91.87),
    "ME": (44.69, -69.38), "MD": (39.06, -76.80), "MA": (42.23, -71.53),
    "MI": (43.33, -84.54), "MN": (45.69, -93.90), "MS": (32.74, -89.68),
    "MO": (38.46, -92.29), "MT": (46.92, -110.45), "NE": (41.13, -98.27),
    "NV": (38.31, -117.06), "NH": (43.45, -71.56), "NJ": (40.30, -74.52),
    "NM": (34.84, -106.25), "NY": (42.17, -74.95), "NC": (35.63, -79.81),
    "ND": (47.53, -99.78), "OH": (40.39, -82.76), "OK": (35.57, -96.93),
    "OR": (44.57, -122.07), "PA": (40.59, -77.21), "RI": (41.68, -71.51),
    "SC": (33.86, -80.95), "SD": (44.30, -99.44), "TN": (35.75, -86.69),
    "TX": (31.05, -97.56), "UT": (40.15, -111.86), "VT": (44.05, -72.71),
    "VA": (37.77, -78.17), "WA": (47.40, -121.49), "WV": (38.49, -80.95),
    "WI": (44.27, -89.62), "WY": (42.76, -107.30),
}
DEFAULT_CENTROID = (39.5, -98.35)
JITTER_DEGREES = (1.5, 2.0)
SPREAD = 32


def centroid_table(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{s}', {lat}D, {lon}D)" for s, (lat, lon) in STATE_CENTROIDS.items())
    return spark.sql(f"VALUES {rows} AS t(centroid_state, centroid_lat, centroid_lon)")


def with_location(
    df: DataFrame, state: str = K.STATE, jitter_by: Sequence[str] = (), seed: int = 0
) -> DataFrame:
    """Add ``lat``/``lon`` from the 50-row centroid table, default point when unknown.

    ``jitter_by`` names the columns that identify a row: its offset is a hash of them,
    so it is the same in every run and under every partitioning.
    """
    lookup = F.broadcast(centroid_table(df.sparkSession))  # 50 rows, fixed
    joined = df.join(lookup, F.col(K.ident(state)) == F.col("centroid_state"), "left")
    columns = {}
    for axis, default, spread in zip(("lat", "lon"), DEFAULT_CENTROID, JITTER_DEGREES):
        point: Column = F.coalesce(F.col(f"centroid_{axis}"), F.lit(default))
        if jitter_by:
            unit = S.unit_hash(*[F.col(K.ident(c)) for c in jitter_by], F.lit(f"{axis}-{seed}"))
            point = point + (unit * 2.0 - 1.0) * F.lit(spread)
        columns[axis] = point
    return joined.withColumns(columns).drop("centroid_state", "centroid_lat", "centroid_lon")


def exposure_join(
    territory: DataFrame, events: DataFrame, keys: Sequence[str], spread: int = SPREAD
) -> DataFrame:
    """Inner equi join: one row per (territory row, event) that share ``keys``.

    Keys with more events than a shuffle partition holds on average are hot. A mergeable
    summary of the frequent keys' hashes, made in the map stage, names them (give or take half
    such a share, which changes the work only): at most as many as there are partitions, which
    bounds what is broadcast. Each of their events takes one of ``spread`` lanes by its content,
    and their territory rows are repeated once per lane. All other keys join as they are.
    """
    if spread <= 1:
        return territory.join(events, list(keys), "inner")
    partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(1 << (8 * partitions + 1024).bit_length(), 1_000_000)
    key = F.xxhash64(*[K.ident(c) for c in keys])
    summary = events.select(key.alias("_hash")).agg(
        F.count(F.lit(1)).alias("_rows"), F.expr(f"approx_top_k(_hash, {min(partitions, tracked)}, {tracked})").alias("_top")
    )
    hot = F.broadcast(
        summary.select("_rows", F.explode("_top").alias("_t")).filter(F.col("_t.count") * partitions > F.col("_rows"))
        .select(F.col("_t.item").alias("_hot"), F.lit(spread).alias("_lanes"))
    )
    lanes = F.coalesce("_lanes", F.lit(1))
    lane = F.pmod(F.xxhash64(*[K.ident(c) for c in events.columns]), lanes).cast("int")
    repeated = F.explode(F.sequence(F.lit(0), lanes - 1))

    def with_lane(side: DataFrame, value: Column) -> DataFrame:
        return side.join(hot, key == F.col("_hot"), "left").withColumn("_lane", value).drop("_hot", "_lanes")

    return with_lane(territory, repeated).join(with_lane(events, lane), [*keys, "_lane"]).drop("_lane")
