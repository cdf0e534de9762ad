import pytest
from pyspark.sql import Observation, functions as F

from gustline import contract as K
from gustline.operators import joins as J, learning as M, quality as Q, reports as R, scoring
from gustline.plans.report import report_tables
from gustline.plans.training import load_model, train_and_store
from gustline.workload import queries as W

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark):
    return W.gold(spark, SF)


def test_feature_sets(gold):
    sets = M.feature_sets(gold)
    assert sets[M.NARROW] == list(K.GOLD_FLAGS)
    assert len(sets[M.WIDE]) == 26
    assert not set(sets[M.WIDE]) & set(K.LABEL_DERIVED)


def test_filter_falls_back_only_when_asked(gold):
    assert R.filtered(gold, state="ZZ").count() == gold.count()
    assert R.filtered(gold, state="ZZ", empty_fallback=False).count() == 0
    assert R.filtered(gold, R.ALL_STATES, R.ALL_TYPES, R.ALL_REGIONS).count() == gold.count()


def test_report_tables(gold):
    tables = report_tables(gold, tiers=[K.HIGH, K.LOW], clusters=3)
    assert set(tables) >= {"kpi", "findings", "clusters", "ranking", "locations"}
    kpi = tables["kpi"].first()
    assert kpi["utilities"] == gold.filter(F.col(K.TIER) != K.MEDIUM).count()
    assert sum(r["utilities"] for r in tables["clusters"].collect()) == kpi["utilities"]
    assert sum(r["utilities"] for r in tables["score_histogram"].collect()) == kpi["utilities"]
    assert tables["tier_mix"].count() == 2


def test_findings_on_an_empty_selection(gold):
    row = R.top_findings(gold.filter(F.lit(False))).first()
    assert (row["top_state"], row["top_state_high_risk"], row["worst_region"]) == ("N/A", 0, "N/A")


def test_comparison_needs_both_names(gold):
    name = gold.select(K.ident(K.NAME)).first()[0]
    assert R.compare_two(gold, name, name).count() == 6
    assert R.compare_two(gold, name, "nobody").count() == 0


def test_exposure_join_spread_keeps_every_pair(spark):
    events = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("e"))
    places = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "k bigint, p string")
    plain, spread = (J.exposure_join(places, events, ["k"], s) for s in (1, 8))
    assert plain.count() == spread.count() == 300
    assert spread.exceptAll(plain).count() == 0


def test_location_jitter_is_bounded_and_stable(spark, gold):
    a = J.with_location(gold, jitter_by=[K.KEY])
    b = J.with_location(gold.repartition(5), jitter_by=[K.KEY])
    assert a.select(K.ident(K.KEY), "lat", "lon").exceptAll(b.select(K.ident(K.KEY), "lat", "lon")).count() == 0
    plain = J.with_location(gold).select(F.col(K.ident(K.KEY)).alias("k"), F.col("lat").alias("la"))
    moved = a.join(plain, F.col(K.ident(K.KEY)) == F.col("k")).agg(F.max(F.abs(F.col("lat") - F.col("la"))))
    assert 0 < moved.first()[0] <= 1.5


def test_split_is_stratified_and_stable(gold):
    split = M.with_test_flag(gold, [K.KEY], K.LABEL)
    shares = {r[0]: r[1] for r in split.groupBy(K.LABEL).agg(F.avg(F.col("is_test").cast("int"))).collect()}
    assert all(abs(s - 0.2) < 0.06 for s in shares.values())
    again = M.with_test_flag(gold.repartition(3), [K.KEY], K.LABEL)
    assert split.filter("is_test").select(K.ident(K.KEY)).exceptAll(
        again.filter("is_test").select(K.ident(K.KEY))).count() == 0


def test_one_hot_ignores_unseen_values(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", None), ("a", 3.0)], "c string, x double")
    unseen = spark.createDataFrame([("zzz", 2.0), (None, None)], train.schema)
    model = M.fit_preprocessing(train, ["x"], ["c"])
    vectors = [r["features"].toArray().tolist() for r in model.transform(unseen).collect()]
    assert vectors[0][1:] == [0.0, 0.0]
    assert vectors[1][1:] == [1.0, 0.0]  # filled with the most frequent value
    assert vectors[0][0] == vectors[1][0]  # filled with the median, 2.0


def test_wide_dictionaries_are_refused(spark):
    train = spark.range(3000).select(F.col("id").cast("string").alias("a b"), F.lit("x").alias("c"))
    M.check_categories(train, ["a b", "c"])
    M.check_categories(train, [])
    M.check_categories(train.limit(0), ["c"])
    with pytest.raises(K.ContractError, match="a b"):
        M.check_categories(train, ["a b", "c"], limit=2000)


def test_balanced_logistic_regression_matches_direct_solution(spark):
    """The penalty mapping: minimise the weighted summed log loss plus half the squared norm."""
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = (rng.random(200) < 1 / (1 + np.exp(-(x - 1)))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, label int")
    spec = M.model_specs()["Logistic Regression"]
    model = M.fit_pipeline(df, spec, ["x"])
    z = (x - x.mean()) / x.std(ddof=1)
    w = np.where(y == 1, 200 / (2 * y.sum()), 200 / (2 * (200 - y.sum())))
    beta = np.zeros(2)
    design = np.c_[z, np.ones(200)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - y)) + [beta[0], 0]
        hessian = design.T @ (design * (w * p * (1 - p))[:, None]) + np.diag([1, 0])
        beta -= np.linalg.solve(hessian, gradient)
    fitted = model.stages[-1]
    assert fitted.coefficients[0] == pytest.approx(beta[0], rel=1e-3)
    assert fitted.intercept == pytest.approx(beta[1], rel=1e-3, abs=1e-4)


def test_grid_trains_stores_and_scores(spark, gold, tmp_path):
    specs = {k: v for k, v in M.model_specs(lr_iterations=20, tree_depth=3).items()
             if k in ("Logistic Regression", "Decision Tree")}
    specs["Broken"] = M.ModelSpec(M.DecisionTreeClassifier, {"maxDepth": 99})
    outcome = train_and_store(gold, str(tmp_path / "m"), specs=specs, top_shares=(0.2,),
                              sets={M.WIDE: M.feature_sets(gold)[M.WIDE]})
    rows = {r["model"]: r for r in outcome.results.collect()}
    assert rows["Broken"]["error"] and rows["Broken"]["pr_auc"] is None
    assert 0 <= rows["Decision Tree"]["pr_auc"] <= 1
    assert outcome.best["pr_auc"] == max(r["pr_auc"] for r in rows.values() if r["pr_auc"] is not None)
    model = load_model(str(tmp_path / "m"))
    requests = spark.createDataFrame([(82.0, 1.5e6, 2.0, 45.0, 7.0, 5.0, 1, "Cooperative")],
        "weather_event_count double, total_damage_usd double, INJURIES_DIRECT double, "
        "MAGNITUDE double, months_with_events double, County_Count double, SERC int, Ownership string")
    derived = scoring.derive_scoring_features(requests)
    scored = scoring.batch_score(model, derived).first()
    assert scored["total_crops_damage_usd"] == pytest.approx(150000.0)
    assert scored["INJURIES_INDIRECT"] == 1.0 and scored["CAISO"] == 0
    assert 0 <= scored["risk_probability"] <= 1 and scored["confidence"] in ("High", "Medium", "Low")


def test_training_queries_do_the_whole_job(spark, monkeypatch):
    from gustline.operators import learning
    from gustline.workload import queries

    asked = {}

    def grid(features, specs=None, top_shares=learning.TOP_SHARES, **more):
        asked.update(specs=learning.model_specs() if specs is None else specs, shares=tuple(top_shares))
        return learning.GridResult(features, None, None)

    monkeypatch.setattr(queries.M, "run_grid", grid)
    where = "/root/testdata/sf0.001"
    queries.QUERIES["train_grid"](spark, where)
    assert asked == {"specs": learning.model_specs(), "shares": (0.10, 0.20)}
    rows = queries.gold(spark, where).count()
    scored = queries.QUERIES["batch_score"](spark, where).count()
    assert 0 < scored <= 0.25 * rows


def test_tables_of_the_cube_are_those_of_the_selection(gold):
    cube = R.Cube(gold)
    for table, more in (
        (R.tier_mix, ()), (R.tier_by_ownership, (2,)), (R.region_heat, (3,)), (R.region_radar, (3,)), (R.top_states, (5,)),
        (R.top_findings, ()), (R.state_metric, ("damage",)), (lambda t: R.kpi_row(t, gold), ()),
    ):
        one, other = (sorted(map(str, table(t, *more).collect())) for t in (cube, gold))
        assert one == other and one


def test_a_report_of_nothing(gold):
    tables = report_tables(gold.filter(F.lit(False)))
    assert {n: t.count() for n, t in tables.items() if t.count()} == {"kpi": 1, "findings": 1}
    row = tables["kpi"].first()
    assert (row["utilities"], row["high_risk"], row["states"], row["avg_saidi"]) == (0, 0, 0, None)


def test_parity_by_tree_equals_the_plain_join(spark, monkeypatch):
    left = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") / 7).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("s"))
    wrong = F.col("k").isin(17, 18, 2500)
    right = left.filter("k <> 40").withColumn("x", F.when(wrong, F.col("x") + 1).otherwise(F.col("x") + 1e-12))
    right = right.withColumn("s", F.when(F.col("k") == 20, "new").otherwise(F.col("s"))).union(spark.createDataFrame([(9999, 1.0, "y")], "k long, x double, s string"))
    plain = sorted(map(tuple, Q.table_parity(left, right, ["k"], ["x", "s"], 1e-9).collect()))
    assert sorted(map(tuple, Q.parity_by_tree(left, right, ["k"], ["x", "s"], 1e-9).collect())) == plain
    assert plain == [("(left only)", 1), ("(right only)", 1), ("s", 1), ("x", 3)]
    joined = []
    monkeypatch.setattr(Q, "table_parity", lambda a, b, *more: joined.append((a.count(), b.count())) or a)
    Q.parity_by_tree(left, left.repartition(3), ["k"], ["x", "s"])
    Q.parity_by_tree(left, left.withColumn("x", F.when(F.col("k") == 5, 0.0).otherwise(F.col("x"))), ["k"], ["x", "s"])
    assert joined[0] == (0, 0) and joined[1] == (1, 1)


def test_jobs_run_together_and_stop_together(spark):
    slow = spark.range(8).repartition(8)
    done = M.run_together(spark, [lambda i=i: slow.where(F.col("id") > i).count() for i in range(6)], 3)
    assert done == [7, 6, 5, 4, 3, 2]

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        M.run_together(spark, [fails, lambda: slow.count()], 2)
    assert slow.count() == 8


def test_a_grid_side_by_side_equals_one_after_another(spark, gold):
    seen = Observation()  # a session that has observed anything can't be serialized with a model
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    specs = {k: v for k, v in M.model_specs(lr_iterations=15, tree_depth=3, forest_trees=4, boost_iterations=2, boost_depth=2).items()}
    wide = {M.WIDE: M.feature_sets(gold)[M.WIDE]}
    results = [M.run_grid(gold, specs, (0.2,), wide, at_once=n) for n in (1, 5)]
    one, other = ([tuple(r) for r in x.results.collect()] for x in results)
    assert one == other and len(one) == 5 and results[0].best == results[1].best
    assert all(row[-1] is None for row in one)


def test_training_partitions_follow_the_cores_not_the_rows(spark, monkeypatch):
    """Every level of every boosted tree is a job with a task for each partition."""
    monkeypatch.setattr(M, "PARTITION_ROWS", 10)
    monkeypatch.setattr(M, "stage", lambda df, label: df)  # a table of 12 files
    rows = spark.range(600).repartition(12)
    cores = spark.sparkContext.defaultParallelism
    parts = [M.training_rows(rows, n).rdd.getNumPartitions() for n in (None, 2)]
    assert parts == [cores, 2]
    monkeypatch.setattr(M, "MOST_PARTITION_ROWS", 100)  # a partition of a large table must still fit into memory
    large = M.training_rows(rows, 2)
    assert large.rdd.getNumPartitions() == 7 and large.count() == 600
    monkeypatch.setattr(M, "PARTITION_ROWS", 1000)
    assert M.training_rows(rows).rdd.getNumPartitions() == 1


def test_boosting_on_flags_reads_equal_rows_as_one(spark, monkeypatch):
    rows = [(float(i % 2), float(i % 3 == 0), int(i % 5 < 1 + i % 2)) for i in range(300)]
    flags = list(K.GOLD_FLAGS[:2])
    df = spark.createDataFrame(rows, f"{flags[0]} double, {flags[1]} double, label int")
    ready = M.fit_preprocessing(df, flags).transform(df).select("label", "features").cache()
    read, plain = [], M.training_rows
    monkeypatch.setattr(M, "training_rows", lambda *a: read.append(plain(*a)) or read[-1])
    for weighting in (None, M.POSITIVE_WEIGHT):
        spec = M.ModelSpec(M.GBTClassifier, {"maxIter": 5, "maxDepth": 2, "seed": M.SEED}, weighting)
        scores = []
        for few in (False, True):
            model = M.fit_classifier(ready, spec, few_vectors=few)
            scored = model.transform(ready).select(M.positive_probability(model.transform(ready)))
            scores.append([r[0] for r in scored.collect()])
        assert scores[0] == pytest.approx(scores[1], abs=1e-9) and len(set(scores[0])) > 1
    assert [r.count() for r in read] == [8, 8]  # four vectors, two labels
    assert [r.agg(F.sum("weight")).first()[0] for r in read] == [300, sum(4 if r[2] else 1 for r in rows)]


def test_the_grid_tells_flags_from_other_columns(spark, monkeypatch):
    asked, plain = [], M.fit_classifier
    monkeypatch.setattr(M, "fit_classifier", lambda *a, **k: asked.append(k["few_vectors"]) or plain(*a, **k))
    flags = list(K.GOLD_FLAGS[:2])
    rows = spark.range(200).select(
        F.col("id").alias(K.KEY), (F.col("id") * 7 % 200 / 200).alias(K.SCORE), F.col("id").cast("double").alias(K.EVENT_COUNT),
        *[(F.col("id") % (i + 2)).cast("double").alias(f) for i, f in enumerate(flags)], F.lit("a").alias(K.REGION),
    )
    specs = {"Decision Tree": M.ModelSpec(M.DecisionTreeClassifier, {"maxDepth": 2})}
    sets = {M.NARROW: flags, M.WIDE: [*flags, K.EVENT_COUNT], "Region": [*flags, K.REGION]}
    results = M.run_grid(rows, specs, (0.2,), sets, at_once=1).results.collect()
    assert asked == [True, False, False] and all(r["error"] is None for r in results)
