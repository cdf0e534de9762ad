import math

from pyspark.sql import functions as F
import pytest

from gustline.functions import scalars as S


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_damage(spark):
    cases = {
        "$1.5M": 1.5e6, "$200K": 2e5, "$2B": 2e9, "nan": 0.0, "": 0.0, "1500000": 1.5e6,
        " 3k ": 3000.0, "1,500": 1500.0, "--": 0.0, "N/A": 0.0, "K": 0.0, "junk": 0.0,
        None: 0.0, "5D": 0.0,
    }
    assert column(spark, cases, S.damage_usd) == list(cases.values())


def test_safe_number(spark):
    cases = {"42": 42.0, "3.14": 3.14, "123": 123.0, "abc": 0.0, "N/A": 0.0, "--": 0.0, None: 0.0}
    assert column(spark, cases, S.safe_number) == list(cases.values())
    assert math.isnan(column(spark, ["nan"], S.safe_number)[0])


def test_strict_double(spark):
    cases = {
        "1": 1.0, " -2.5 ": -2.5, "1e3": 1000.0, "5.": 5.0, ".5": 0.5, "+7": 7.0,
        "inf": math.inf, "-Infinity": -math.inf, "1d": None, "1f": None, "0x1p3": None,
        "0X1P3": None, "": None, "abc": None, "1-2": None, "$5": None, "1,000": None, None: None,
    }
    assert column(spark, cases, S.strict_double) == list(cases.values())
    assert column(spark, ["NaN", "inf", None, "x"], S.coerced) == [0.0, math.inf, 0.0, 0.0]


def test_integer_key_rounds_half_even(spark):
    cases = {"1": 1, "1.5": 2, "2.5": 2, " 7.0 ": 7, "x": None, "nan": None, "inf": None, None: None}
    assert column(spark, cases, S.integer_key) == list(cases.values())


def test_text_fills(spark):
    cases = {" a ": "a", "": "Unknown", "  ": "Unknown", None: "Unknown", "N/A": "N/A"}
    assert column(spark, cases, S.text_or_unknown) == list(cases.values())
    cases = {" a ": "a", "": "Unknown", "  ": "", None: "Unknown", "N/A": "Unknown"}
    assert column(spark, cases, S.filled_then_stripped) == list(cases.values())


def test_event_time(spark):
    cases = {
        "01-APR-24 10:40:00": "2024-04-01 10:40:00", "1-Apr-24 1:02:03": "2024-04-01 01:02:03",
        "31-DEC-68 00:00:00": "2068-12-31 00:00:00", "01-JAN-69 00:00:00": "1969-01-01 00:00:00",
        "31-FEB-24 00:00:00": None, "2024-04-01": None, "": None, None: None,
    }
    got = column(spark, cases, lambda c: S.event_time(c).cast("string"))
    assert got == list(cases.values())


def test_half_even(spark):
    cases = {"0.25": 0.2, "0.35": 0.4, "2.5": 2.5}
    got = column(spark, cases, lambda c: S.half_even(c.cast("double"), 1))
    assert got == list(cases.values())


def test_region_flag_modes(spark):
    assert column(spark, ["Y", "1", "", None], S.region_flag) == [0.0, 1.0, 0.0, 0.0]
    yes_no = column(spark, ["Y", "1", "", None], lambda c: S.region_flag(c, "yes_no"))
    assert yes_no == [1.0, 1.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        S.region_flag(F.col("v"), "other")


def test_risk_verdict(spark):
    df = spark.createDataFrame([(0.8,), (0.5,), (0.42,), (0.3,), (0.1,)], "p double")
    rows = df.select(*[v.alias(k) for k, v in S.risk_verdict(F.col("p")).items()]).collect()
    assert [r["confidence"] for r in rows] == ["High", "Low", "Low", "Medium", "High"]
    assert [r["risk_label"] for r in rows][:3] == ["High Risk", "High Risk", "Medium/Low Risk"]
    assert "(probability: 80.00%). Recommend" in rows[0]["message"]


def test_loose_times_numbers_and_keys(spark):
    """Texts that a lenient reader takes: blanks, one-digit parts; and a key out of range."""
    from gustline.functions import scalars as S

    times = ["1-APR-24 1:4:0", " 01-APR-24 10:40:00", "01-APR-24 10:40:00 ", "01-APR-24  10:40:00", "01-APR-4 10:40:00", "01-APR-24"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(S.event_time(F.col("t")).cast("string").alias("x"))
    late = "2024-04-01 10:40:00"
    assert [r["x"] for r in rows.collect()] == ["2024-04-01 01:04:00", late, late, late, "2004-04-01 10:40:00", None]
    cells = spark.createDataFrame([("7\n",), ("9223372036854775807",), ("-9223372036854775808",), ("8.5",)], "t string")
    got = cells.select(S.strict_double(F.col("t")).alias("d"), S.integer_key(F.col("t")).alias("k")).collect()
    assert [r["k"] for r in got] == [7, None, -(2**63), 8] and got[0]["d"] == 7.0


def test_fingerprint_sees_a_shifted_value(spark):
    from gustline.operators.quality import table_fingerprint

    prints = [
        table_fingerprint(spark.createDataFrame([row], "a string, b string")).first()["fingerprint"]
        for row in (("x", None), (None, "x"), ("x", None))
    ]
    assert prints[0] == prints[2] != prints[1]
