import io
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gustline import contract as K
from gustline.operators import joins as J, ranking as W
from gustline.operators.risk import risk_features
from gustline.operators.rollup import utility_rollup
from gustline.session import stage


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows: a third share one value, some are missing, the rest are spread."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=4000).round(2)
    x[rng.random(4000) < 0.33] = 0.0
    pdf = pd.DataFrame({"k": range(4000), "x": x, "g": rng.integers(0, 3, 4000)})
    pdf.loc[pdf.k % 50 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf)
    return pdf, stage(df.withColumn("x", F.nanvl("x", F.lit(None).cast("double"))), "skewed")


def test_percent_rank_equals_pandas(skewed):
    pdf, df = skewed
    got = W.with_percent_rank(df, {"r": "x"}, ["k"]).toPandas().sort_values("k")
    want = pdf.x.rank(pct=True, na_option="bottom")
    assert len(got) == len(pdf)
    assert (got.r.to_numpy() == want.to_numpy()).all()


def test_quantiles_equal_pandas(skewed):
    pdf, df = skewed
    shares = [0.0, 0.5, 0.8, 0.9, 0.95, 1.0]
    got = W.exact_quantiles(df, "x", shares).first()["q"]
    assert got == pdf.x.quantile(shares).tolist()
    by = {r["g"]: r["q"] for r in W.exact_quantiles(df, "x", shares, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert by[g] == part.x.quantile(shares).tolist()
    assert W.column_medians(df, ["x", "k"]) == {"x": pdf.x.median(), "k": pdf.k.median()}


def test_plan_spreads_hot_values(skewed):
    _, df = skewed
    text = plan(W.with_percent_rank(df, {"r": "x"}, ["k"]))
    assert "Join" not in text and "CartesianProduct" not in text
    assert "Python" not in text
    # The lane is part of the shuffle's key, so hot rows do not meet in one reducer.
    dealt = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert len(dealt) == 1 and "_lane" in dealt[0]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ranks_of_any_number_of_ranges(spark, skewed, parts):
    pdf, df = skewed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        two = df.withColumn("same", F.lit(4.0)).withColumn("none", F.lit(None).cast("double"))
        got = W.with_percent_rank(two, {"r": "x", "s": "same", "n": "none"}, ["k"]).toPandas().sort_values("k")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (got.r.to_numpy() == pdf.x.rank(pct=True, na_option="bottom").to_numpy()).all()
    assert set(got.s) == set(got.n) == {(4000 + 1) / 2 / 4000}


def test_quantiles_of_many_values(spark):
    """Brackets far narrower than the values, on values spread over many magnitudes."""
    rng = np.random.default_rng(1)
    x = np.concatenate([np.exp(rng.normal(0, 9, 60_000)), -rng.random(20_000), np.full(20_000, 2.5), [np.inf, -np.inf]])
    pdf = pd.DataFrame({"x": x, "g": np.where(rng.random(len(x)) < 0.9, "a", None)})
    df = stage(spark.createDataFrame(pdf), "many")
    shares = [0.001, 0.3, 0.5, 0.501, 0.999]
    by = {r["g"]: r["q"] for r in W.exact_quantiles(df, "x", shares, ["g"]).collect()}
    for g, part in (("a", pdf[pdf.g == "a"]), (None, pdf[pdf.g.isna()])):
        assert by[g] == pytest.approx(part.x.quantile(shares).tolist(), rel=1e-9)
    assert W.exact_quantiles(df, "x", shares).first()["q"] == pytest.approx(pdf.x.quantile(shares).tolist(), rel=1e-9)
    empty = df.limit(0)
    assert W.exact_quantiles(empty, "x", [0.5]).first()["q"] == [None] and W.column_medians(empty, ["x"]) == {}


def test_metrics_equal_definition(spark):
    rng = np.random.default_rng(3)
    score = rng.random(500).round(2)
    label = (rng.random(500) < score).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    row = W.binary_metrics(df, "s", "y").first()
    pos, neg = score[label == 1], score[label == 0]
    pairs = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert row["roc_auc"] == pytest.approx(pairs / (len(pos) * len(neg)))
    average, before = 0.0, 0.0
    for cut in sorted(set(score), reverse=True):
        called = score >= cut
        recall, precision = label[called].sum() / label.sum(), label[called].mean()
        average, before = average + (recall - before) * precision, recall
    assert row["pr_auc"] == pytest.approx(average)
    called = score >= 0.5
    precision, recall = label[called].mean(), label[called].sum() / label.sum()
    assert row["precision"] == pytest.approx(precision)
    assert row["recall"] == pytest.approx(recall)
    assert row["f1"] == pytest.approx(2 * precision * recall / (precision + recall))


def test_metrics_without_positive_calls(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "s double, y int")
    row = W.binary_metrics(df, "s", "y").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_scores_and_tiers_by_hand(spark):
    saidi, saifi = [0.0, 0.0, 0.0, 100.0, 200.0], [0.0, 1.0, 1.0, 2.0, 3.0]
    rows = [(i, a, b, 3.0) for i, (a, b) in enumerate(zip(saidi, saifi))]
    df = spark.createDataFrame(rows, f"`{K.KEY}` bigint, {K.SAIDI} double, {K.SAIFI} double, {K.COUNTIES} double")
    out = risk_features(stage(df, "hand")).orderBy(K.ident(K.KEY)).collect()
    assert [r[K.SAIDI_RANK] for r in out] == [0.4, 0.4, 0.4, 0.8, 1.0]
    assert [r[K.SAIFI_RANK] for r in out] == [0.2, 0.5, 0.5, 0.8, 1.0]
    assert [r[K.SCORE] for r in out] == pytest.approx([0.3, 0.45, 0.45, 0.8, 1.0])
    assert [r[K.TIER] for r in out] == [K.LOW, K.MEDIUM, K.MEDIUM, K.MEDIUM, K.HIGH]
    assert [r[K.LABEL] for r in out] == [0, 0, 0, 0, 1]
    assert out[4][K.LOSS] == 200 / 60 * 3 * 50000 * 27 and out[4][K.BREACH] == 1
    assert out[3][K.MARGIN] == -50.0


def test_rollup_with_a_hot_utility(spark):
    """One utility holds a third of all events; the result equals pandas."""
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({
        K.KEY: np.where(rng.random(n) < 0.34, 1, rng.integers(2, 60, n)),
        K.SAIDI: rng.integers(0, 300, n).astype(float),
        K.DAMAGE[0]: rng.integers(0, 9999, n) / 4, K.DAMAGE[1]: rng.integers(0, 99, n) / 4,
        K.EVENT_TYPE: "Hail", K.MONTH: rng.choice(["April", "May", "Unknown"], n),
        K.ROW_ID: range(n),
    })
    pdf[K.NAME] = "U" + pdf[K.KEY].astype(str)
    df = spark.createDataFrame(pdf).union(
        spark.createDataFrame([(None, 1.0, 1.0, 1.0, "Hail", "May", n, "x")],
                              f"`{K.KEY}` bigint, a double, b double, c double, d string, e string, f bigint, g string")
    )
    want = pdf.groupby(K.KEY).agg(
        name=(K.NAME, "first"), saidi=(K.SAIDI, "max"), damage=(K.DAMAGE[0], "sum"),
        events=(K.EVENT_TYPE, "count"), months=(K.MONTH, "nunique"),
    )
    got = utility_rollup(df).toPandas().set_index(K.KEY).sort_index()
    assert got[K.NAME].tolist() == want.name.tolist()
    assert got[K.SAIDI].tolist() == want.saidi.tolist()
    assert got["total_property_damage_usd"].tolist() == want.damage.tolist()
    assert got[K.EVENT_COUNT].tolist() == want.events.tolist()
    assert got[K.MONTH_COUNT].tolist() == want.months.tolist()
    tree = plan(utility_rollup(df)).split("\n\n")[0].splitlines()
    row_level = [line for line in tree if "Aggregate" in line][-1]  # nearest the scan
    assert " HashAggregate" in row_level


def test_small_amounts_are_not_lost(spark):
    rows = [(1, 0.00004, 4e-11), (1, 0.00004, 4e-11)]
    df = spark.createDataFrame(rows, f"`{K.KEY}` bigint, `{K.DAMAGE[0]}` double, `{K.DAMAGE[1]}` double")
    row = utility_rollup(df).first()
    assert (row["total_property_damage_usd"], row["total_crops_damage_usd"]) == (0.00008, 8e-11)


def test_exposure_join_splits_hot_keys_only(spark):
    events = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    territory = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    split, plain = (J.exposure_join(territory, events, ["k"], n) for n in (32, 1))
    assert split.count() == plain.count() and split.exceptAll(plain).count() == 0
    assert "_lane" in plan(split) and "NestedLoop" not in plan(split)
