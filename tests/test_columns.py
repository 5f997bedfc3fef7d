from __future__ import annotations

import pytest
from helpers import rows, transactions
from pyspark.sql import functions as F

from txsieve.functions import clock, text
from txsieve.operators import enrich

NORMAL = "Transaction appears normal based on its characteristics."


def test_ratios_at_zero_and_null(spark):
    given = transactions(
        spark,
        ("a", 0, 0, 5, 1, 1, 1, 1),
        ("b", 2, 4, 5, 1, 1, 1, 1),
        ("c", None, 4, 5, 1, 1, 1, 1),
    )
    plain = enrich.with_ratios(given).select("hash", "fee_rate", "fee_per_weight")
    assert rows(plain) == [("a", None, None), ("b", 2.5, 1.25), ("c", None, 1.25)]
    guarded = enrich.with_guarded_ratios(given).select("hash", "fee_rate", "fee_per_weight")
    assert rows(guarded) == [("a", 5.0, 5.0), ("b", 2.5, 1.25), ("c", None, 1.25)]


def test_threshold_is_strict(spark):
    given = spark.createDataFrame([(1.0,), (1.0001,), (None,)], "anomaly_score double")
    flags = [row[1] for row in enrich.flag_by_threshold(given).collect()]
    assert flags == [False, True, None]


def test_flag_fallback(spark):
    given = spark.createDataFrame(
        [(-1.0, 0.0), (1.0, 9.0), (0.7, 0.7), (0.5, 0.5)], "prediction double, anomaly_score double"
    )
    flags = [row["is_anomaly"] for row in enrich.flag_with_fallback(given).collect()]
    assert flags == [True, False, True, False]


@pytest.mark.parametrize(
    "size, fee, inputs, outputs, flag, expected",
    [
        (10, 1, 60, 60, False, NORMAL),
        (
            100,
            20000,
            1,
            1,
            True,
            "Potential anomaly detected: Unusually high fee rate (200.00 satoshis/byte)",
        ),
        (
            20000,
            5,
            51,
            99,
            True,
            "Potential anomaly detected: Unusually low fee rate (0.00 satoshis/byte); "
            "Unusually large transaction size (20000 bytes); "
            "Unusually high number of inputs (51); Unusually high number of outputs (99)",
        ),
        (
            10000,
            10000,
            50,
            50,
            True,
            "Potential anomaly detected: Combination of transaction characteristics "
            "deviates from normal patterns",
        ),
        (
            0,
            7,
            51,
            1,
            True,
            "Potential anomaly detected: Unusually high number of inputs (51)",
        ),
    ],
)
def test_explanation(spark, size, fee, inputs, outputs, flag, expected):
    given = transactions(spark, ("h", size, 4, fee, inputs, outputs, 1, 1))
    explained = enrich.with_explanation(given.withColumn("is_anomaly", F.lit(flag)))
    assert explained.first()["explanation"] == expected


def test_rule_names_the_rate_even_when_only_the_size_fired(spark):
    given = transactions(
        spark,
        ("size", 20000, 4, 1000000, 1, 1, 1, 1),
        ("rate", 10, 4, 1001, 1, 1, 1, 1),
        ("edge", 10, 4, 1000, 1, 1, 1, 1),
        ("zero", 0, 4, 1000, 1, 1, 1, 1),
    )
    found = {row[0]: tuple(row[1:]) for row in enrich.rule_check(given).collect()}
    prefix = "Potential anomaly detected: Unusual fee rate"
    assert found["size"] == (1.5, True, f"{prefix} (50.00 satoshis/byte)")
    assert found["rate"] == (1.5, True, f"{prefix} (100.10 satoshis/byte)")
    assert found["edge"] == (0.2, False, NORMAL)
    assert found["zero"] == (0.2, False, NORMAL)


def test_two_decimals_agree_with_printf(spark):
    values = [0.125, 0.375, 1234567.005, 2.675, 1e-9, 99.995, 0.0]
    frame = spark.createDataFrame([(value,) for value in values], "v double")
    shown = [row[0] for row in frame.select(text.two_decimals(F.col("v"))).collect()]
    assert shown == [f"{value:.2f}" for value in values]


def test_range_hours():
    assert clock.range_hours("6h") == 6
    assert clock.range_hours("all") is None
    with pytest.raises(ValueError):
        clock.range_hours("6 days")
