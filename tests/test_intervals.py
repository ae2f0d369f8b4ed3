import pytest
from pyspark.sql import functions as F

from leafline.operators import intervals

CALLS = "model string, started_at double, ended_at double, input_tokens long, output_tokens long, errored boolean"


@pytest.mark.parametrize(
    ("spans", "union", "peak"),
    [
        ([(10, 13)], 3, 1),
        ([(5, 8), (0, 2)], 5, 1),
        ([(0, 5), (4, 7)], 7, 2),
        ([(0, 10), (3, 6)], 10, 2),
        ([(0, 10)] * 5, 10, 5),
        ([(0, 1), (1, 2), (2, 3)], 3, 1),
        ([(0, 5), (2, 6), (3, 10)], 10, 3),
    ],
)
@pytest.mark.parametrize("bucket", [2.0, 3600.0])
def test_union_and_peak(spark, spans, union, peak, bucket):
    df = spark.createDataFrame([("m", float(a), float(b), 0, 0, False) for a, b in spans], CALLS)
    assert intervals.union_length(df, bucket=bucket).first()["wall_s"] == union
    assert intervals.peak_concurrency(df, bucket=bucket).first()["peak"] == peak


def test_errors_bring_tokens_but_no_interval(spark):
    df = spark.createDataFrame([("m", 0.0, 3.0, 10, 2, False), ("m", 1.0, 9.0, 0, 0, True), ("m", None, None, 0, 0, True)], CALLS)
    r = intervals.summary(df).first()
    assert (r["count"], r["errors"], r["compute_time_s"], r["wall_clock_time_s"], r["max_concurrent"], r["avg_call_s"]) == (3, 2, 3.0, 3.0, 1, 1.0)
    assert tuple(intervals.token_totals(df).first()) == (10, 2, 12)


def test_no_calls(spark):
    df = spark.createDataFrame([], CALLS)
    assert intervals.summary(df).count() == 0
    assert tuple(intervals.token_totals(df).first()) == (0, 0, 0)


def test_one_unpriced_model_voids_the_total(spark):
    t = spark.createDataFrame([("a", 1_000_000, 0), ("ocr:a", 0, 1_000_000), ("b", 1, 1)], "model string, input_tokens long, output_tokens long")
    prices = spark.createDataFrame([("a", 3.0, 15.0)], "model string, input_rate double, output_rate double")
    costs = intervals.priced(t, prices)
    assert {r["model"]: r["cost_usd"] for r in costs.collect()} == {"a": 3.0, "ocr:a": 15.0, "b": None}
    assert intervals.total_cost(costs).first()["cost_usd"] is None
    assert intervals.total_cost(costs.where("model <> 'b'")).first()["cost_usd"] == 18.0
    assert intervals.total_cost(costs.limit(0)).first()["cost_usd"] == 0.0


def test_percentiles_interpolate(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    s = df.agg(intervals.stat_summary(F.col("v")).alias("s")).first()["s"]
    assert (s["count"], s["max"], s["p50"]) == (4, 4.0, 2.5)
    assert abs(s["p95"] - 3.85) < 1e-12
    assert df.limit(0).agg(intervals.stat_summary(F.col("v")).alias("s")).first()["s"] is None
