import pandas as pd
import pytest
from pyspark.sql import functions as F

from feed_rows import ACCEPTED, REPEATED, as_file, mixed_events, usual_events
from gustline import contract as K
from gustline.operators import clean as C, quality as Q
from gustline.plans.layered import expected_counts, run_gated, run_layers
from gustline.plans.tolerant import clean_file
from gustline.sources import commits, layers as L, publish as P
from gustline.sources.delimited import (
    header_columns, malformed, probe_columns, read_text_columns, well_formed,
)
from gustline.sources.manifest import read_manifest


def test_landed_rows_are_text_with_lineage(spark, landed):
    data, _, manifest = landed
    bronze = L.read_batch(spark, data, L.BRONZE, L.EVENTS, "t1")
    assert manifest["bronze"]["rows"] == bronze.count() == 10
    types = dict(bronze.dtypes)
    assert all(types[c] == "string" for c in (*K.EVENT_CONTRACT, "EXTRA_COL"))
    rows = bronze.select("_batch_id", "_source_file", K.ROW_ID, "_ingested_at").collect()
    assert {r["_batch_id"] for r in rows} == {"t1"}
    assert {r["_source_file"] for r in rows} == {"raw file.csv"}
    assert len({r[K.ROW_ID] for r in rows}) == len(rows)
    assert all(r["_ingested_at"] is not None for r in rows)


def test_a_batch_lands_once(spark, landed):
    data, raw, _ = landed
    with pytest.raises(FileExistsError):
        run_layers(spark, raw, data, "t1")


def test_manifest_counts(landed):
    silver = landed[2]["silver"]
    assert silver["quarantine_by_reason"] == {"invalid_state": 2, "negative_value": 1}
    assert (silver["quarantined"], silver["duplicates_removed"], silver["rows"]) == (3, 2, 5)
    assert silver["bronze_rows_in"] == 10
    soft = silver["soft_expectations"]
    assert soft["coerced_to_zero"][K.SAIDI]["unparseable"] == 1
    assert soft["coerced_to_zero"][K.MAGNITUDE]["null_or_nan"] == 1
    assert soft["utility_number_missing"] == 0


def test_quarantine_table(spark, landed):
    rows = L.read_batch(spark, landed[0], L.SILVER, L.QUARANTINE, "t1")
    assert rows.columns[:2] == [K.ROW_ID, K.REJECT_REASON]
    reasons = sorted(r[0] for r in rows.select(K.REJECT_REASON).collect())
    assert reasons == ["invalid_state", "invalid_state", "negative_value"]


def test_accepted_rows_are_typed_and_filled(spark, landed):
    silver = L.silver_contract(L.read_batch(spark, landed[0], L.SILVER, L.EVENTS, "t1"))
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in K.silver_schema()
    ]
    rows = {r[K.KEY]: r for r in silver.collect()}
    assert rows[300][K.MAGNITUDE] == 0.0 and rows[500][K.SAIDI] == 0.0
    assert rows[400][K.OWNERSHIP] == "Unknown" and rows[400][K.REGION] == "WECC"
    assert str(rows[100][K.EVENT_TS]) == "2024-04-01 10:40:00"


def test_gold_has_46_columns(spark, landed):
    gold = L.read_batch(spark, landed[0], L.GOLD, L.FEATURES, "t1")
    assert len(gold.columns) == landed[2]["gold"]["feature_columns"] == 46
    assert gold.columns[0] == K.KEY and gold.columns[-1] == K.LABEL
    assert gold.agg(F.max("TRE")).first()[0] == 0.0


def test_manifest(spark, landed):
    stored = read_manifest(spark, landed[0], "t1")
    assert stored["batch_id"] == "t1" and "PASS" in stored["identity_check"]
    assert stored["source"]["file"] == "raw file.csv" and stored["source"]["fingerprint"]


def test_file_without_a_contract_column_builds_nothing(spark, tmp_path):
    raw = as_file(usual_events(5).drop(columns=K.EVENT_TYPE), tmp_path / "bad.csv")
    with pytest.raises(K.ContractError, match="EVENT_TYPE"):
        run_layers(spark, raw, str(tmp_path / "d"), "x")
    assert not (tmp_path / "d" / "silver").exists()


def test_gate_stops_a_dirty_batch(spark, tmp_path):
    events = usual_events(100, **{K.STATE: ["ZZ"] * 30 + ["TX"] * 70, K.KEY: [str(i) for i in range(100)]})
    raw = as_file(events, tmp_path / "dirty.csv")
    with pytest.raises(K.DataQualityError, match="quarantined"):
        run_gated(spark, raw, str(tmp_path / "d"), max_quarantine_pct=5.0)
    assert not (tmp_path / "d" / "silver").exists() and not (tmp_path / "d" / "gold").exists()


def test_gated_run_publishes_and_reconciles(spark, tmp_path):
    events = usual_events(41, **{K.KEY: [str(100 + i % 40) for i in range(41)], "SPP.1": "Y"})
    raw = as_file(events, tmp_path / "clean.csv")
    data, target = str(tmp_path / "d"), str(tmp_path / "published")
    manifest = run_gated(spark, raw, data, publish_to=target, database="storms")
    assert manifest["silver"]["rows"] == 40 and manifest["silver"]["duplicates_removed"] == 1
    assert manifest["quality_gate"]["quarantine_pct"] == 0.0
    batch = manifest["batch_id"]
    again = P.publish(spark, data, target, batch)
    checks = P.reconcile_published(spark, again, {**expected_counts(manifest), "silver_quarantine": 0})
    assert {r["table"] for r in checks.where("matches").collect()} >= {"bronze_outage_events", "silver_outage_events", "gold_utility_features"}
    silver = spark.read.parquet(again["tables"]["silver_outage_events"]["location"])
    assert silver.count() == 40
    entry = spark.read.parquet(f"{target}/manifest").first()
    assert (entry["batch_id"], entry["silver_rows"], entry["utilities"]) == (batch, 40, 40)
    assert {"utility_number", "spp_1", "batch_id"} <= set(silver.columns)
    assert not any(" " in c or "." in c for c in silver.columns)
    assert spark.table("storms.silver_outage_events").filter(F.col("batch_id") == batch).count() == 40
    text = "\n".join(P.table_ddl(again, "storms", external_syntax=True))
    assert "PARTITIONED BY (batch_id string)" in text and "`utility_number` bigint" in text
    assert f"ADD IF NOT EXISTS PARTITION (batch_id='{batch}')" in text
    spark.sql("DROP DATABASE storms CASCADE")


def test_snake_names_never_collide(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a", "A", "a_1", "."])
    assert P.snake_columns(df).columns == ["a", "a_1", "a_1_1", "col"]
    assert P.snake_name("SPP.1") == "spp_1" and P.snake_name("_row_id") == "row_id"


def test_ragged_lines(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('x,y,SPP.1\n1,"say ""hi""",Y\n2,b\n3,c,d,e\n4,,"q, r"\n')
    lines = read_text_columns(spark, str(path))
    assert header_columns(spark, str(path)) == ["x", "y", "SPP.1"]
    good = well_formed(lines)
    assert sorted(r[0] for r in good.select("x").collect()) == ["1", "4"]
    assert good.filter("x = '1'").first()["y"] == 'say "hi"'
    assert sorted(r["line"] for r in malformed(lines).collect()) == ["2,b", "3,c,d,e"]
    with pytest.warns(UserWarning):
        assert probe_columns(spark, str(path), ["y", "z"]) == ["y"]
    out = L.land_bronze(spark, str(path), str(tmp_path / "d"), "b", "2024-01-01 00:00:00")
    assert out["rows"] == 2 and out["malformed_lines_skipped"] == 2
    kept = spark.read.parquet(L.batch_path(str(tmp_path / "d"), L.BRONZE, L.REJECTED_LINES, "b"))
    assert kept.count() == 2


def test_tolerant_clean_equals_silver_on_clean_rows(spark, landed, tmp_path):
    events = pd.concat([mixed_events().loc[[*ACCEPTED, *REPEATED]], usual_events(1, **{K.STATE: "ZZ"})])
    raw = as_file(events, tmp_path / "p.csv")
    cleaned = clean_file(spark, raw, str(tmp_path / "clean"), str(tmp_path / "csv"))
    silver = L.silver_contract(L.read_batch(spark, landed[0], L.SILVER, L.EVENTS, "t1"))
    compared = [*K.FLOAT_COLUMNS, *K.DEFAULTED_TEXT, K.STATE, K.NAME, "TRE"]
    parity = Q.table_parity(cleaned, silver, [K.KEY], compared)
    assert {r["rows"] for r in parity.collect()} == {0}
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 5
    narrow = spark.createDataFrame([("TX", "5"), ("QQ", "6")], ["State", "MAGNITUDE"])
    with pytest.warns(UserWarning):
        assert C.clean_tolerant(narrow).collect()[0][K.MAGNITUDE] == 5.0


def test_dedup_with_a_hot_row(spark):
    """A third of all rows are copies of one row; no copy is lost or kept twice."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.col("id").alias(K.ROW_ID),
    )
    out = C.collapse_duplicates(rows, ["a", "b"])
    assert out.count() == 2001
    assert out.filter("a = 0").first()[K.COPIES] == 1000
    assert out.agg(F.sum(K.COPIES)).first()[0] == 3000


def test_parity_and_difference_find_changes(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, None), (3, 3.0, "z")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, 2.5, None), (4, 3.0, "z")], a.schema)
    rows = {r[0]: r[1] for r in Q.table_parity(a, b, ["k"], ["v", "s"], 1e-9).collect()}
    assert rows == {"v": 1, "s": 0, "(left only)": 1, "(right only)": 1}
    twice = a.union(a.limit(1))
    assert Q.exact_difference(a, a).count() == 0
    assert Q.exact_difference(twice, a).first()["left_copies"] == 2


def published_rows(spark, target):
    names = ("bronze/outage_events", "silver/outage_events", "gold/utility_features", "gold/state_risk_summary")
    return {n: commits.read_published(spark, target, n).groupBy("batch_id").count().collect() for n in names}


def test_a_batch_is_published_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    data, target = str(tmp_path / "d"), str(tmp_path / "published")
    raw = as_file(usual_events(30, **{K.KEY: [str(i) for i in range(30)]}), tmp_path / "a.csv")
    run_layers(spark, raw, data, batch_id="007")
    P.publish(spark, data, target, "007")
    before = published_rows(spark, target)
    assert all(rows == [("007", 30 if "gold/state" not in name else 1)] for name, rows in before.items())

    more = as_file(usual_events(12, **{K.KEY: [str(i) for i in range(12)]}), tmp_path / "b.csv")
    other = str(tmp_path / "other")
    run_layers(spark, more, other, batch_id="007")
    write, seen = commits.write_batch, []

    def failing(df, location, batch_id):
        seen.append(location)
        if len(seen) == 4:
            raise OSError("disk gone")
        write(df, location, batch_id)

    with monkeypatch.context() as patch, pytest.raises(OSError, match="disk gone"):
        patch.setattr(commits, "write_batch", failing)
        P.publish(spark, other, target, "007")
    with pytest.raises(K.ContractError, match="silver_outage_events"):
        P.publish(spark, other, target, "007", {"silver_outage_events": 13})
    assert published_rows(spark, target) == before
    assert spark.read.parquet(f"{target}/silver/outage_events").count() == 30

    # after the commit the new tables count, wherever the move is cut off
    after = {name: [("007", 12 if "gold/state" not in name else 1)] for name in before}
    for steps in (1, 4, 7):
        P.publish(spark, data, target, "007")
        done = []
        with monkeypatch.context() as patch, pytest.raises(OSError, match="cut off"):
            for action in ("remove", "rename"):
                def cut(self, *names, _do=getattr(commits.Folder, action)):
                    if any(n.startswith("_commits") for n in names):  # the commit itself
                        return _do(self, *names)
                    if len(done) == steps:
                        raise OSError("cut off")
                    done.append(names)
                    return _do(self, *names)
                patch.setattr(commits.Folder, action, cut)
            P.publish(spark, other, target, "007")
        assert published_rows(spark, target) == after
        assert commits.recover(spark, target) == ["007"] and commits.recover(spark, target) == []
        assert published_rows(spark, target) == after
        assert spark.read.parquet(f"{target}/gold/utility_features").count() == 12
        assert not (tmp_path / "published" / "_pending" / "007").exists()


def test_a_table_that_lost_its_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(5)
    for filled in (5, 0, 3):
        attempt = commits.Attempt(spark, target, "a:b")
        attempt.write(rows.limit(filled), "silver/quarantine")
        assert attempt.rows("silver/quarantine") == filled
        attempt.commit()
        if filled:
            assert commits.read_published(spark, target, "silver/quarantine").groupBy("batch_id").count().collect() == [("a:b", filled)]
        else:
            with pytest.raises(FileNotFoundError):
                commits.read_published(spark, target, "silver/quarantine")


def shuffle_files(spark):
    import glob

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in blocks for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_a_stored_step_leaves_no_shuffle_behind(spark, tmp_path):
    from gustline.session import SHUFFLE_CLEANUP, freed_shuffles
    from gustline.sources import layers
    from gustline.sources.delimited import export_csv

    dealt = spark.range(10_000).selectExpr("id", "id % 7 as k").repartition(3, "k")
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    layers.write_table(dealt, str(tmp_path / "t"))
    export_csv(dealt, str(tmp_path / "c"))
    assert not shuffle_files(spark) - before and spark.conf.get(SHUFFLE_CLEANUP) == setting
    with freed_shuffles(spark), freed_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert spark.read.parquet(str(tmp_path / "t")).count() == dealt.count() == 10_000


def test_packed_files_are_small_and_hold_the_same_rows(spark, tmp_path):
    import gzip

    from gustline.sources.delimited import export_csv, read_text_columns

    rows = spark.range(0, 1000, 1, 2).selectExpr("cast(id as string) k", "if(id % 3 = 0, ' a \"b\", ', null) v", "if(id = 700, 'x\ny', 'z') w")
    folder = tmp_path / "packed"
    path = export_csv(rows, str(folder), 150)
    files = sorted(folder.glob("*.csv.gz"))
    assert len(files) == 8 and all(gzip.decompress(f.read_bytes()).startswith(b"k,v,w\n") for f in files)
    back = read_text_columns(spark, path)
    assert sorted(map(tuple, back.select("k", "v", "w").collect())) == sorted(map(tuple, rows.collect()), key=str)
    assert back.where("_corrupt is not null").count() == 0 and not list(folder.glob("*.csv"))


def test_copies_are_removed_slice_by_slice(spark, landed, tmp_path, monkeypatch):
    import pathlib

    from gustline.plans import layered
    from gustline.sources import layers

    _, raw, whole = landed
    assert [layered.slices_of(n) for n in (0, layered.SLICE_ROWS - 1, layered.SLICE_ROWS, 10**12)] == [1, 1, 2, 8]
    routes, seen, write = [], [], layers.write_table

    def noted(df, path, mode="errorifexists"):
        out = write(df, path, mode)
        if "/silver/outage_events/" in path:
            seen.append(mode)
            routes.append(sorted(p.name for p in staged[0].glob("_route=*")))
        return out

    staged, routed = [], layered.route_batch

    def remembered(*args):
        path, profile = routed(*args)
        staged.append(pathlib.Path(path))
        return path, profile

    monkeypatch.setattr(layered, "SLICE_ROWS", 4)
    monkeypatch.setattr(layered, "route_batch", remembered)
    monkeypatch.setattr(layers, "write_table", noted)
    called = []
    manifest = layered.run_layers(spark, raw, str(tmp_path / "data"), "t1", on_landed=lambda: called.append(layers.path_exists(spark, str(tmp_path / "data/silver"))))
    assert called == [False] and seen == ["overwrite", "append", "append"] and not staged[0].exists()
    assert all(not any(r.startswith("_route=rejected") for r in found) for found in routes)
    assert len(routes[0]) >= len(routes[1]) >= len(routes[2]) and len(routes[0]) > 0

    def rows(data):
        silver = layers.read_batch(spark, data, layers.SILVER, layers.EVENTS, "t1")
        return sorted(map(str, silver.drop(K.ROW_ID).collect()))

    assert rows(str(tmp_path / "data")) == rows(landed[0])
    for layer in ("bronze", "silver", "gold"):
        numbers = {k: v for k, v in whole[layer].items() if isinstance(v, int)}
        assert {k: manifest[layer][k] for k in numbers} == numbers


def test_a_run_stores_no_bronze_of_its_own_and_no_csv_stays(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from gustline import session
    from gustline.workload import queries

    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"C{i}", 0, "BUILDING", i - 3.5) for i in range(6)],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "orders": ([(i, i % 6, "O") for i in range(30)], "o_orderkey long, o_custkey long, o_orderstatus string"),
        "lineitem": ([(i % 30, i // 30 + 1, 2.0, 10.0, 0.1, "A", "OF"[i % 2], datetime(1995, 3, 2)) for i in range(90)],
                     "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(session, "staging_root", lambda _: str(tmp_path / "stage"))
    monkeypatch.setattr(queries, "staging_root", lambda _: str(tmp_path / "stage"))
    landed = queries.QUERIES["bronze_lineage"](spark, str(tmp_path)).first()
    ran = queries.QUERIES["layered_run"](spark, str(tmp_path)).first()
    assert landed["rows"] == landed["row_ids"] == ran["bronze_rows"] == 135
    made = sorted(map(str, queries.gold(spark, str(tmp_path)).collect()))
    kinds = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "stage").iterdir()}
    assert "layers" in kinds and not kinds & {"bronze", "feed-csv", "routed"}
    again = queries.build_features(queries.silver(spark, str(tmp_path)))  # of stored Bronze
    assert sorted(map(str, again.collect())) == made and len(made) == 6


def test_a_row_passes_the_observation_with_what_is_written_or_counted(spark, landed, tmp_path, monkeypatch):
    from gustline.plans import layered

    texts = ["", "  ", None, "NaN", " nan ", "inf", "1.5", "x", "-3", "1d", "0x1p3", " 7 "]
    cells = [usual_events(1).iloc[0].to_dict() | {K.MAGNITUDE: t, K.SAIDI: t, K.KEY: t, "long": "y" * n} for t, n in zip(texts, range(58, 70))]
    schema = ", ".join(f"{K.ident(c)} string" for c in cells[0])
    rows = spark.createDataFrame([tuple(None if v is None else str(v) for v in c.values()) for c in cells], schema)
    rows.withColumn(K.ROW_ID, F.monotonically_increasing_id()).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    passed, observe = [], type(stored).observe
    monkeypatch.setattr(type(stored), "observe", lambda df, *a: (passed.append(df.columns), observe(df, *a))[1])
    path, profile = layered.route_batch(spark, str(tmp_path / "b"))
    L.remove_path(spark, path)
    assert len(passed) == 1 and len(passed[0]) == 1 + len(K.EVENT_CONTRACT) + len(Q.PROFILED)
    counts = {r["column_name"]: {"null_or_nan": r["null_or_nan"], "unparseable": r["unparseable"]} for r in Q.soft_profile(stored).collect()}
    assert profile["soft_expectations"]["coerced_to_zero"] == counts
    assert counts[K.MAGNITUDE] == {"null_or_nan": 5, "unparseable": 3}
    assert profile["soft_expectations"]["utility_number_missing"] == Q.missing_keys(stored).first()[0] == 6
    assert profile["fingerprint"] == Q.table_fingerprint(stored.drop(K.ROW_ID)).first()["fingerprint"]
