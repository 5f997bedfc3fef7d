"""Transactions derived from the given tables, with the matching SQL.

The SQL fragments are written for DuckDB and serve as independent oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.operators.enrich import flag_by_threshold, with_ratios
from txsieve.sources.commits import table_exists
from txsieve.sources.history import file_position

#: Rows of a landed file: more files let more tasks work on a batch.
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_transactions(events: DataFrame, *extra: object) -> DataFrame:
    """One transaction per event row; batch or streaming.

    ``transaction_time`` keeps the stored type, so that a time filter on it is
    still a filter on the stored column and reaches the scan.
    """
    size = F.get_json_object("props", "$.k").cast("int")
    fee = F.floor(F.col("value") * 100).cast("bigint")
    return events.select(
        F.concat(F.lit("tx_"), F.col("event_id")).alias("hash"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        F.col("ts").alias("transaction_time"),
        size.alias("size"),
        (4 * size).alias("weight"),
        fee.alias("fee"),
        (1 + F.col("event_id") % 9).cast("int").alias("inputs_count"),
        (1 + F.col("user_id") % 4).cast("int").alias("outputs_count"),
        (fee + 1000 * size).alias("input_value"),
        (1000 * size).cast("bigint").alias("output_value"),
        F.col("event_type").alias("label"),
        *extra,
    )


TXE_SQL = """
select event_id, user_id, hash, time, transaction_time, size, 4 * size as weight, fee,
       cast(1 + event_id % 9 as int) as inputs_count,
       cast(1 + user_id % 4 as int) as outputs_count,
       cast(fee + 1000 * size as bigint) as input_value,
       cast(1000 * size as bigint) as output_value,
       label
from (
  select event_id, user_id, 'tx_' || event_id as hash,
         cast(floor(epoch(ts)) as bigint) as time, ts as transaction_time,
         cast(json_extract_string(props, '$.k') as int) as size,
         cast(floor(value * 100) as bigint) as fee, event_type as label
  from events
)"""


def event_transactions(spark: SparkSession, sf_dir: str, *extra: object) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"), *extra)


def enriched_transactions(spark: SparkSession, sf_dir: str, *extra: object) -> DataFrame:
    return with_ratios(event_transactions(spark, sf_dir, *extra))


ENRICHED_SQL = f"""
select *, fee / nullif(size, 0) as fee_rate, fee / nullif(weight, 0) as fee_per_weight
from ({TXE_SQL})"""


def identified_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched transactions with the row identity that sampling needs."""
    return enriched_transactions(spark, sf_dir, file_position().alias("row_id"))


def scored_transactions(spark: SparkSession, sf_dir: str, *extra: object) -> DataFrame:
    """Enriched transactions with a stand-in score: the standardised fee.

    Mean and deviation come from averages of integers, which do not depend on
    the order of rows, so both engines compute the same doubles.
    """
    tx = enriched_transactions(spark, sf_dir, *extra)
    fee = F.col("fee").cast("double")
    fees = event_transactions(spark, sf_dir).agg(
        F.avg("fee").alias("mean"), F.avg(fee * fee).alias("mean_square")
    )
    fees = fees.select("mean", F.sqrt(F.col("mean_square") - F.col("mean") * F.col("mean")).alias("sd"))
    mean, sd = fees.select("mean").scalar(), fees.select("sd").scalar()
    return flag_by_threshold(tx.withColumn("anomaly_score", (fee - mean) / sd))


SCORED_SQL = f"""
select e.*, (fee - mean) / sd as anomaly_score, (fee - mean) / sd > 1.0 as is_anomaly
from ({ENRICHED_SQL}) e,
     (select mean, sqrt(mean_square - mean * mean) as sd
      from (select cast(sum(fee) as double) / count(*) as mean,
                   cast(sum(fee * fee) as double) / count(*) as mean_square
            from ({TXE_SQL})))"""


def slices(events: DataFrame, n: int, displaced: bool = False) -> DataFrame:
    """Events with the slice of time, of ``n`` equal ones, in which they arrive: ``slice``.

    Displaced, every tenth event comes two slices late.
    """
    total = events.agg(F.count(F.lit(1))).scalar()
    own = F.floor(F.col("event_id") * n / total).cast("int")
    if displaced:
        own = F.least(own + F.when(F.col("event_id") % 10 == 3, 2).otherwise(0), F.lit(n - 1))
    return events.withColumn("slice", own)


def slice_sql(n: int, displaced: bool = False) -> str:
    own = f"cast(floor(event_id * {n} / (select count(*) from events)) as int)"
    return f"least({own} + case when event_id % 10 = 3 then 2 else 0 end, {n - 1})" if displaced else own


def files_a_slice(events: DataFrame, rows: int = FILE_ROWS) -> int:
    """Files of at most about ``rows`` rows that the largest slice needs."""
    largest = events.groupBy("slice").count().agg(F.max("count")).first()[0]
    return max(1, -(-(largest or 0) // rows))


def land_slices(events: DataFrame, folder: str, wanted: range, files: int = 1) -> None:
    """``files`` Parquet files for each slice, in order, for a stream that takes as many files a batch.

    A slice that fills fewer files gets empty ones, so that no batch takes files of two slices.
    """
    spark = events.sparkSession
    for k in wanted:
        rows = events.where(F.col("slice") == k).drop("slice")
        before = _landed(spark, folder)
        rows.repartition(files).write.mode("append").parquet(folder)
        for _ in range(before + files - _landed(spark, folder)):
            rows.limit(0).coalesce(1).write.mode("append").parquet(folder)


def _landed(spark: SparkSession, folder: str) -> int:
    return len(spark.read.parquet(folder).inputFiles()) if table_exists(spark, folder) else 0


def partly_scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored transactions, where those with a missing feature have no score."""
    scored = F.col("fee_rate").isNotNull()
    return scored_transactions(spark, sf_dir).withColumns(
        {name: F.when(scored, F.col(name)) for name in ("anomaly_score", "is_anomaly")}
    )


PARTLY_SCORED_SQL = f"""
select * replace (case when fee_rate is not null then anomaly_score end as anomaly_score,
                  case when fee_rate is not null then is_anomaly end as is_anomaly)
from ({SCORED_SQL})"""


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order; orders without line items have NULL features.

    Line items are reduced per order before the join, so an order with very
    many items crosses the shuffle as a few partial rows.
    """
    amount = F.col("l_extendedprice")
    items = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").cast("int").alias("size"),
            (4 * F.sum("l_quantity") - F.count("l_orderkey")).cast("int").alias("weight"),
            F.sum(F.floor(amount * F.col("l_tax") * 100)).cast("bigint").alias("fee"),
            F.count("l_orderkey").cast("int").alias("inputs_count"),
            F.count_distinct("l_suppkey").cast("int").alias("outputs_count"),
            F.sum(F.floor(amount * 100)).cast("bigint").alias("input_value"),
            F.sum(F.floor(amount * (1 - F.col("l_discount")) * 100))
            .cast("bigint")
            .alias("output_value"),
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    zero = F.lit(0)
    return joined.select(
        F.concat(F.lit("tx_"), F.col("o_orderkey")).alias("hash"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("time"),
        F.col("o_orderdate").alias("transaction_time"),
        "size",
        "weight",
        "fee",
        F.coalesce("inputs_count", zero).alias("inputs_count"),
        F.coalesce("outputs_count", zero).alias("outputs_count"),
        "input_value",
        "output_value",
    )


TX_SQL = """
select 'tx_' || o_orderkey as hash, cast(epoch(o_orderdate) as bigint) as time,
       o_orderdate as transaction_time,
       cast(sum(l_quantity) as int) as size,
       cast(4 * sum(l_quantity) - count(l_orderkey) as int) as weight,
       cast(sum(floor(l_extendedprice * l_tax * 100)) as bigint) as fee,
       cast(count(l_orderkey) as int) as inputs_count,
       cast(count(distinct l_suppkey) as int) as outputs_count,
       cast(sum(floor(l_extendedprice * 100)) as bigint) as input_value,
       cast(sum(floor(l_extendedprice * (1 - l_discount) * 100)) as bigint) as output_value
from orders left join lineitem on l_orderkey = o_orderkey
group by o_orderkey, o_orderdate"""

TX_ENRICHED_SQL = f"""
select *, fee / nullif(size, 0) as fee_rate, fee / nullif(weight, 0) as fee_per_weight
from ({TX_SQL})"""


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed documents as JSON text, one per event.

    Each holds one to three nested transactions, built from the row alone. All
    irregular shapes occur: no ``inputs`` key, empty ``inputs``, an input
    without ``prev_out`` and an output without ``value``. Error events land a
    second text that is no JSON, next to their document.
    """
    zero_based = F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int"))
    tx = event_transactions(spark, sf_dir, "event_id")

    def an_input(k: object) -> object:
        present = F.struct((F.col("fee") + k).alias("value"))
        return F.struct(F.when(k % 4 != 0, present).alias("prev_out"))

    def an_output(k: object) -> object:
        return F.struct(F.when(k % 3 != 0, 1000 * F.col("size") + k).alias("value"))

    inputs = F.transform(F.sequence(F.lit(1), F.col("inputs_count")), an_input)
    outputs = F.transform(F.sequence(F.lit(1), F.col("outputs_count")), an_output)
    shape = F.col("event_id") % 5

    def a_transaction(j: object) -> object:
        return F.struct(
            F.concat(F.col("hash"), F.lit("_"), j).alias("hash"),
            F.col("time").alias("time"),
            F.col("size").alias("size"),
            F.col("weight").alias("weight"),
            (F.col("fee") + j).alias("fee"),
            F.when(shape == 1, F.slice(inputs, 1, 0)).when(shape > 1, inputs).alias("inputs"),
            outputs.alias("out"),
        )

    document = F.to_json(F.struct(F.transform(zero_based, a_transaction).alias("txs")))
    broken = F.concat(F.lit("not json "), F.col("hash"))
    landed = F.when(F.col("label") == "error", F.array(document, broken))
    return tx.select(F.explode(landed.otherwise(F.array(document))).alias("value"))


FEED_SQL = f"""
select hash || '_' || j as hash, time, size, weight, fee + j as fee,
       case when event_id % 5 > 1 then inputs_count when event_id % 5 = 1 then 0 end
         as nested_inputs,
       outputs_count as nested_outputs,
       case when event_id % 5 > 1
            then (select coalesce(sum(case when k % 4 <> 0 then fee + k end), 0)
                  from range(1, inputs_count + 1) r(k)) else 0 end as input_value,
       (select coalesce(sum(case when k % 3 <> 0 then 1000 * size + k end), 0)
        from range(1, outputs_count + 1) r(k)) as output_value
from (select *, unnest(range(0, event_id % 3 + 1)) as j
      from ({TXE_SQL}))"""
