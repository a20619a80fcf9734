"""Operator units on tiny frames: stockout classes, anomaly labels, scalars."""

import datetime as dt
import math

from pyspark.sql import functions as F

from shelfcast.contracts import cast_to_contract, ML_CONTRACTS, normalise_header, truthy, RAW_CONTRACTS
from shelfcast.functions.scalar import interval_lower, interval_upper, local_time_text, risk_category
from shelfcast.operators import scoring


def test_class_boundaries(spark):
    df = spark.createDataFrame([(0.59,), (0.60,), (0.90,), (0.91,), (1.10,), (1.11,)], "s double")
    got = [r[0] for r in df.select(risk_category("s")).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "Critical"]


def test_score_frame(spark):
    df = spark.createDataFrame(
        [(110.0, 100.0), (10.0, 0.0), (10.0, None), (10.0, -5.0), (50.0, 100.0), (75.0, 100.0), (105.0, 100.0),
         (140.0, 100.0)],
        "predicted_demand double, available_inventory double",
    )
    rows = scoring.score_stockout(df).collect()
    assert rows[0]["risk_category"] == "High"
    assert rows[1]["stockout_risk_score"] == math.inf and rows[1]["risk_category"] == "Critical"
    assert rows[2]["stockout_risk_score"] is None and rows[2]["risk_category"] == "Critical"
    assert rows[3]["stockout_risk_score"] == math.inf
    assert [r["risk_category"] for r in rows[4:]] == ["Low", "Medium", "High", "Critical"]
    assert rows[7]["recommended_action"].startswith("Escalate immediately")


def _anoms(spark, values, threshold):
    df = spark.createDataFrame([(1, 1, dt.date(2012, 1, 6) + dt.timedelta(days=7 * i), v) for i, v in enumerate(values)],
                               "store_id int, dept_id int, sales_date date, weekly_sales double")
    return scoring.detect_sales_anomalies(df, threshold).orderBy("sales_date").collect()


def test_spike(spark):
    rows = _anoms(spark, [100.0, 105.0, 98.0, 500.0], 1.5)
    assert round(rows[3]["anomaly_score"], 4) == 1.7319
    assert (rows[3]["severity"], rows[3]["direction"], rows[3]["is_anomaly"]) == ("Medium", "Sales spike", True)
    assert all((r["severity"], r["direction"], r["is_anomaly"]) == ("Low", "Sales drop", False) for r in rows[:3])


def test_constant_and_null_groups(spark):
    rows = _anoms(spark, [7.0, 7.0, 7.0], 2.0)
    assert all(r["anomaly_score"] == 0.0 and r["severity"] == "Low" and r["direction"] == "Sales drop"
               and not r["is_anomaly"] for r in rows)
    rows = _anoms(spark, [100.0, None, 105.0], 2.0)
    assert rows[1]["anomaly_score"] is None and rows[1]["severity"] == "Low" and not rows[1]["is_anomaly"]
    assert rows[1]["direction"] == "Sales drop"


def test_severity_high_above_threshold(spark):
    # High is fixed at 3 even when the flag threshold is higher.
    rows = _anoms(spark, [0.0] * 20 + [100.0], 5.0)
    assert rows[-1]["severity"] == "High" and not rows[-1]["is_anomaly"]


def test_truthy_words(spark):
    df = spark.createDataFrame([("TRUE",), ("1",), ("yes",), ("no",), (None,)], "w string")
    assert [r[0] for r in df.select(truthy(F.col("w"))).collect()] == [True, True, True, False, False]


def test_interval(spark):
    df = spark.createDataFrame([(-10.0,), (100.0,)], "p double")
    got = df.select(interval_lower("p", 2), interval_upper("p", 2)).collect()
    assert [tuple(r) for r in got] == [(0.0, -11.5), (85.0, 115.0)]


def test_header_variants():
    known = RAW_CONTRACTS["features"].names + RAW_CONTRACTS["sales"].names + ["store_type"]
    for raw, want in [("Weekly_Sales", "weekly_sales"), ("WeeklySales", "weekly_sales"),
                      ("Weekly Sales", "weekly_sales"), ("IsHoliday", "is_holiday"), ("Is_Holiday", "is_holiday"),
                      ("Fuel_Price", "fuel_price"), ("FuelPrice", "fuel_price"), ("Type", "store_type"),
                      ("Store_Type", "store_type"), ("MarkDown1", "markdown1"), ("MarkDown_1", "markdown1")]:
        assert normalise_header(raw, known) == want, raw


def test_ml_output_contract_read(spark):
    df = spark.createDataFrame(
        [("1", "2", "2012-01-06", "0", "123.4", "NA", "1.0", "2.0", "m", "v", "2026-05-21T23:18:11+00:00",
          "2026-05-21T23:18:11+00:00")],
        "Store string, Dept string, Forecast_Date string, Horizon_Days string, Predicted_Demand string, "
        "Actual_Demand string, Prediction_Interval_Lower string, Prediction_Interval_Upper string, "
        "Model_Name string, Model_Version string, Trained_At string, Created_At string",
    )
    row = cast_to_contract(df, ML_CONTRACTS["demand_forecasts"]).first()
    assert row["created_at"] == dt.datetime(2026, 5, 21, 23, 18, 11)
    assert row["actual_demand"] is None and row["predicted_demand"] == 123.4 and row["forecast_date"] == dt.date(2012, 1, 6)


def test_anomaly_contract_booleans(spark):
    df = spark.createDataFrame(
        [("1", "1", "2012-01-06", "1.5", "2.5", w, "High", "Sales spike", "v", "bad") for w in ("True", "0", "yes")],
        "store string, dept string, sales_date string, weekly_sales string, anomaly_score string, "
        "is_anomaly string, severity string, direction string, model_version string, created_at string",
    )
    rows = cast_to_contract(df, ML_CONTRACTS["sales_anomalies"]).collect()
    assert [r["is_anomaly"] for r in rows] == [True, False, True]
    assert rows[0]["created_at"] is None


def test_local_time_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 0, 0),), (dt.datetime(2024, 7, 5, 0, 0),), (None,)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(local_time_text("t")).collect()]
    assert got == ["Jan 04, 2024 07:00 PM EST", "Jul 04, 2024 08:00 PM EDT", "Not available"]


def test_empty_stockout_output_keeps_contract(spark):
    fc = spark.createDataFrame([], ML_CONTRACTS["demand_forecasts"].columns)
    out = scoring.stockout_output(fc, None)
    assert out.count() == 0 and out.columns == ML_CONTRACTS["stockout_risk"].names


def test_timestamps_to_utc_seconds(spark):
    df = spark.createDataFrame([("2026-05-21T23:18:11+00:00",), ("2026-05-21T19:18:11.75-04:00",), ("bad",)], "t string")
    from shelfcast.contracts import coerce
    from pyspark.sql import types as T

    got = [r[0] for r in df.select(coerce(F.col("t"), T.StringType(), T.TimestampNTZType())).collect()]
    assert got == [dt.datetime(2026, 5, 21, 23, 18, 11), dt.datetime(2026, 5, 21, 23, 18, 11), None]


def test_stddev_of_large_totals(spark):
    """n^2 * x^2 beyond 38 digits, and values that differ by little."""
    from pyspark.sql import functions as F
    from shelfcast.functions.scalar import money_stddev_pop

    big = spark.range(12).select(F.lit(9e13).alias("x"))
    assert big.agg(money_stddev_pop("x")).first()[0] == 0.0
    near = spark.range(1000).select((F.lit(5e8) + F.col("id") % 2).alias("x"))
    assert near.agg(money_stddev_pop("x")).first()[0] == 0.5
    assert spark.range(0).select(F.col("id").cast("double").alias("x")).agg(money_stddev_pop("x")).first()[0] is None
