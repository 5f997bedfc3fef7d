from __future__ import annotations

import datetime as dt
import json

from helpers import rows, transactions
from pyspark.sql import functions as F

from txsieve.operators import records
from txsieve.sources import feed

NESTED = {
    "txs": [
        {
            "hash": "a",
            "time": 10,
            "size": 1,
            "weight": 4,
            "fee": 5,
            "inputs": [{"prev_out": {"value": 7}}, {}, {"prev_out": {}}],
            "out": [{"value": 3}, {}],
        },
        {"hash": "b", "inputs": []},
        {"hash": "c"},
    ]
}


def documents(spark):
    texts = [json.dumps(NESTED), "{broken", "{}", json.dumps({"txs": []})]
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_flatten_counts_and_sums_missing_parts_as_zero(spark):
    flat = records.flatten_transactions(records.explode_feed(documents(spark)))
    assert rows(flat) == [
        ("a", 10, 1, 4, 5, 3, 2, 7, 3),
        ("b", None, None, None, None, 0, 0, 0, 0),
        ("c", None, None, None, None, 0, 0, 0, 0),
    ]


def test_feed_files_by_line_and_whole(spark, tmp_path):
    lines, whole = str(tmp_path / "lines"), tmp_path / "whole"
    documents(spark).write.text(lines)
    assert feed.read_feed(spark, lines).count() == 3
    whole.mkdir()
    (whole / "doc.json").write_text(json.dumps(NESTED, indent=2))
    assert feed.read_feed(spark, str(whole), whole_files=True).count() == 3


def test_decode_keeps_unreadable_messages(spark):
    texts = ['{"hash":"x","size":"no number","fee":3}', "garbage", None]
    sent = spark.createDataFrame([(text,) for text in texts], "value string")
    decoded = records.decode_messages(sent.select(F.col("value").cast("binary").alias("value")))
    assert decoded.count() == 3
    kept = decoded.where("hash is not null").first()
    assert (kept["hash"], kept["size"], kept["fee"]) == ("x", None, 3)
    assert decoded.where("hash is null and fee is null").count() == 2


def test_messages_round_trip_with_nulls(spark):
    flat = records.flatten_transactions(records.explode_feed(documents(spark)))
    sent = records.to_messages(flat)
    assert json.loads(sent.where("value like '%\"c\"%'").first()[0])["time"] is None
    assert rows(records.decode_messages(sent)) == rows(flat)


def test_event_time_replaces_seconds(spark):
    sent = spark.createDataFrame([("h", 1_700_000_000), ("n", None)], "hash string, time bigint")
    timed = records.with_event_time(sent)
    assert "time" not in timed.columns
    found = {row["hash"]: row for row in timed.collect()}
    assert found["h"]["transaction_time"] == dt.datetime.fromtimestamp(1_700_000_000)
    assert found["n"]["transaction_time"] is None
    assert found["n"]["processing_time"] is not None


def test_input_defaults(spark):
    given = transactions(spark, ("", 0, None, 0, 0, None, 0, None), ("h", 1, 2, 3, 4, 5, 6, 7))
    assert rows(records.with_input_defaults(given)) == [
        ("h", 1, 2, 3, 4, 5, 6, 7),
        ("test_transaction", 250, 1000, 5000, 2, 2, 1000000, 995000),
    ]


def test_json_rows_keep_milliseconds(spark):
    frame = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 2, 3, 4, 5, 678901), None)], "k string, t timestamp, v double"
    )
    text = records.to_json_rows(frame)
    assert json.loads(text.first()[0]) == {"k": "a", "t": "2024-01-02T03:04:05.678", "v": None}
    back = records.from_json_rows(text, frame.schema).first()
    assert back["t"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
