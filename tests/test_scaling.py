"""What a task holds and what is shuffled on the way from events to utilities."""

import contextlib
import io

from pyspark.sql import functions as F

from feed_rows import as_file, mixed_events, usual_events
from gustline import contract as K
from gustline import session
from gustline.operators import clean as C
from gustline.operators import quality as Q
from gustline.operators.rollup import utility_rollup


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def bronze(spark, events, path):
    rows = spark.read.option("header", True).csv(as_file(events, path))
    return rows.withColumn(K.ROW_ID, F.monotonically_increasing_id())


def test_a_task_scans_a_bounded_part_of_the_files(spark):
    before = spark.conf.get(session.SPLIT_BYTES)
    try:
        for asked, wanted in (("128m", 16 << 20), ("134217728b", 16 << 20), ("1m", 1 << 20)):
            spark.conf.set(session.SPLIT_BYTES, asked)
            session.tune(spark)
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(session.SPLIT_BYTES)) == wanted
    finally:
        spark.conf.set(session.SPLIT_BYTES, before)


def test_event_times_are_read_after_copies_are_removed(spark, tmp_path):
    typed = C.typed_events(bronze(spark, mixed_events(), tmp_path / "e.csv"))
    silver = C.silver_events(typed)
    assert silver.columns == [*K.SILVER_COLUMNS, K.ROW_ID, K.COPIES]
    same = C.collapse_duplicates(C.accepted(typed), K.SILVER_COLUMNS).select(*[K.ident(c) for c in silver.columns])
    assert sorted(map(str, silver.collect())) == sorted(map(str, same.collect())) and silver.count() == 5
    assert "gettimestamp" in plan(silver) and "gettimestamp" not in plan(Q.duplicate_count(silver))


def test_months_are_counted_without_a_group_each(spark, tmp_path):
    cells = ["April", "April", "May", "may", "May ", "", "n/a", "Unknown", "Unknown", "July"]
    events = usual_events(10, **{K.MONTH: cells, K.NAME: ["A", "B"] * 5, K.MAGNITUDE: [str(i) for i in range(10)]})
    silver = C.silver_events(C.typed_events(bronze(spark, events, tmp_path / "e.csv")))
    got = utility_rollup(silver)
    row = got.first()
    known = silver.agg(F.count_distinct(K.MONTH)).first()[0]
    assert known == 6 and (row[K.MONTH_COUNT], row[K.EVENT_COUNT], row[K.NAME]) == (known, 10, "A")
    assert got.schema[K.MONTH_COUNT].dataType.simpleString() == "bigint"
    empty = utility_rollup(silver.withColumn(K.MONTH, F.lit(None).cast("string"))).first()
    assert empty[K.MONTH_COUNT] == 0
    assert utility_rollup(silver.drop(K.MONTH)).first()[K.EVENT_COUNT] == 10
    keys = [line for line in plan(got).splitlines() if line.startswith("Keys") and K.NAME in line and K.EVENT_TIME_TEXT not in line]
    assert keys and not any(K.MONTH in line for line in keys)


def test_the_fingerprint_adds_up_in_longs(spark):
    import hashlib

    rows = [(None, "a"), ("", "é:1"), ("x", None), ("x", None), *((str(i), "y" * (i % 5)) for i in range(300))]
    df = spark.createDataFrame(rows, "a string, b string")
    shown = ["".join("-" if c is None else f"{len(c)}:{c}" for c in r) for r in rows]
    digests = [hashlib.md5(s.encode()).hexdigest() for s in shown]
    wanted = "-".join(str(sum(int(d[15 * i:15 * i + 15], 16) for d in digests)) for i in (0, 1))
    got = Q.table_fingerprint(df)
    assert tuple(got.first()) == (len(rows), wanted) and Q.table_fingerprint(df.limit(0)).first()[1] == "0-0"
    sums = [line for line in plan(got).splitlines() if "sum(" in line and "decimal" in line.split("sum(")[1].split(")")[0]]
    assert not sums  # decimals only in the end


def test_stored_tables_are_cut_into_small_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    from gustline.sources import layers

    rows = spark.range(500_000, numPartitions=1).select(F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = layers.write_table(rows, str(tmp_path / "t"))
    groups = [pq.ParquetFile(f).metadata for f in (tmp_path / "t").glob("*.parquet")]
    assert path and sum(m.num_rows for m in groups) == 500_000 and sum(m.num_row_groups for m in groups) >= 3


def test_the_usual_time_needs_no_formatter(spark):
    from gustline.functions import scalars as S

    months = ["JAN", "feb", "Mar", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC", "ANF", "XYZ"]
    texts = [f"{d}-{m}-{y} {c}" for d in ("00", "01", "29", "31") for m in months for y in ("00", "23", "68", "69", "72", "99")
             for c in ("00:00:00", "23:59:59", "24:00:00", "10:60:00", "10:40:60", "10:40:07\u2028")]
    rows = spark.createDataFrame([(t,) for t in [*texts, None, "", " 01-APR-24 10:40:00"]], "t string")
    times = rows.select("t", S.event_time(F.col("t")).alias("new"), S._formatted_time(F.col("t")).alias("old"))
    assert times.where("not new <=> old").count() == 0 and times.where("new is not null").count() == 367
    text = plan(times.select("new"))
    assert 0 < text.index("JANFEB") < text.index("gettimestamp")  # the formatter comes second


def test_paired_quotes_are_not_matched(spark, tmp_path):
    import itertools
    import re

    from gustline.sources import quoted

    cells = ["", '""', '"""', '""""', "a", '"a', 'a"', '"a"', 'a""b', ' "']
    values = sorted({",".join(c) for n in (1, 2, 3) for c in itertools.product(cells, repeat=n)})
    (tmp_path / "t.csv").write_text("".join(f"{v}\n" for v in values))
    got = {r["value"]: (r["opens"], r["stays"]) for r in quoted._lines(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {v: (bool(re.search(quoted.OPENS.replace("\\z", "\\Z"), v)), bool(re.search(quoted.STAYS.replace("\\z", "\\Z"), v))) for v in values}
    assert "StringReplace" in plan(quoted._lines(spark, str(tmp_path / "t.csv"))) or "replace(" in plan(quoted._lines(spark, str(tmp_path / "t.csv")))


def test_cells_are_written_before_a_line_is_delivered_twice(spark, tmp_path):
    from datetime import datetime

    from gustline.sources.delimited import file_name
    from gustline.workload import feed

    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "C1", 0, "BUILDING", -3.5)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "orders": ([(5, 1, "O")], "o_orderkey long, o_custkey long, o_orderstatus string"),
        "lineitem": ([(5, i, 2.0, 10.0, 0.1, "A", s, datetime(1995, 3, 2)) for i, s in ((1, "O"), (2, "F"), (3, None))],
                     "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    events = feed.raw_events(spark, str(tmp_path))
    got = sorted((r[K.ROW_ID], r[K.EVENT_TIME_TEXT], r[K.NAME]) for r in events.collect())
    assert got == [(82, "02-MAR-95 01:40:00", "C1"), (83, "02-MAR-95 01:40:00", "C1"), (84, "02-MAR-95 02:40:00", "C1"), (86, "02-MAR-95 03:40:00", "C1")]
    wide = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(wide)
    try:
        spark.conf.set(wide, "1000")
        text = feed.raw_events(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(wide, before)
    assert text.index("Generate explode(CASE WHEN") < text.index("JANFEB")  # the tree shows what comes last first
    names = spark.createDataFrame([("file:/x/a%20b%2Bc+d.csv",), ("a+b.csv",), (None,)], "p string")
    assert [r[0] for r in names.select(file_name(F.col("p"))).collect()] == ["a b+c+d.csv", "a+b.csv", None]
