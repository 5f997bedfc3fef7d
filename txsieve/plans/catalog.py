"""Every registered query with its oracle SQL, side by side."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsieve.operators import enrich, features, filters, joins, monitoring, records, reports, states
from txsieve.operators.iforest import AnomalyModel, average_path, fit_isolation_forest
from txsieve.operators.quantiles import exact_quantiles
from txsieve.operators.scoring import score_report
from txsieve.operators.windows import window_stats
from txsieve.plans import fixtures as fx
from txsieve.plans import forest_sql, jobs
from txsieve.schemas import CAP_QUANTILE, FEATURES, MESSAGE_FIELDS, NODE_SCHEMA
from txsieve.session import materialize, scratch_path
from txsieve.sources import commits, exports, feed, history, messages, registry, runlog
from txsieve.streaming import live, pipelines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Add a query. Without ``oracle`` SQL cannot express it."""

    def add(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Stored times carry no zone; the zone is bound when a plan is analysed.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Times without zone, as the oracle returns them."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round doubles whose last digits depend on the order of a sum."""
    return df.withColumns({name: F.round(F.col(name), DIGITS) for name in names})


def rounded_sql(names: list[str]) -> str:
    return ", ".join(f"round({name}, {DIGITS}) as {name}" for name in names)


def columns_sql(names: list[str]) -> str:
    return ", ".join(names)


TX_COLUMNS = [
    "hash",
    "transaction_time",
    "size",
    "weight",
    "fee",
    "inputs_count",
    "outputs_count",
    "input_value",
    "output_value",
]
FEATURE_DOUBLES = ", ".join(f"cast({name} as double) as {name}" for name in FEATURES)
ALL_PRESENT = " and ".join(f"{name} is not null" for name in FEATURES)
SECONDS = "make_timestamp(time * 1000000)"


# --- sources, messages, nested records ------------------------------------


@register(
    "raw_feed_explode",
    f"select hash, time, size, weight, fee, nested_inputs, nested_outputs from ({fx.FEED_SQL})",
)
def raw_feed_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "feed")
    fx.feed_documents(spark, sf_dir).write.text(path)
    return feed.read_feed(spark, path).select(
        "hash",
        "time",
        "size",
        "weight",
        "fee",
        F.array_size("inputs").alias("nested_inputs"),
        F.array_size("out").alias("nested_outputs"),
    )


@register(
    "raw_feed_rejected",
    f"select 'not json ' || hash as value from ({fx.TXE_SQL}) where label = 'error'",
)
def raw_feed_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "feed")
    fx.feed_documents(spark, sf_dir).write.text(path)
    return feed.read_rejected(spark, path)


@register(
    "flatten_tx",
    f"""select hash, time, size, weight, fee,
        cast(coalesce(nested_inputs, 0) as int) as inputs_count,
        cast(nested_outputs as int) as outputs_count,
        cast(input_value as bigint) as input_value, cast(output_value as bigint) as output_value
        from ({fx.FEED_SQL})""",
)
def flatten_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = records.explode_feed(fx.feed_documents(spark, sf_dir))
    return records.flatten_transactions(nested)


_MESSAGE_SQL = """'{' || '"hash":"' || hash || '","time":' || time || ',"size":' || size
  || ',"weight":' || weight || ',"fee":' || fee || ',"inputs_count":' || inputs_count
  || ',"outputs_count":' || outputs_count || ',"input_value":' || input_value
  || ',"output_value":' || output_value || '}'"""


@register("to_message_json", f"select {_MESSAGE_SQL} as value from ({fx.TXE_SQL})")
def to_message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.to_messages(fx.event_transactions(spark, sf_dir))


@register("json_decode", f"select {columns_sql(MESSAGE_FIELDS)} from ({fx.TXE_SQL})")
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = records.to_messages(fx.event_transactions(spark, sf_dir))
    return records.decode_messages(sent.select(F.col("value").cast("binary").alias("value")))


@register(
    "json_roundtrip",
    f"""select hash, date_trunc('milliseconds', transaction_time) as transaction_time, size,
        weight, fee, inputs_count, outputs_count, input_value, output_value, label,
        fee_rate, fee_per_weight, anomaly_score, is_anomaly from ({fx.SCORED_SQL})""",
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = fx.scored_transactions(spark, sf_dir).drop("time")
    return records.from_json_rows(records.to_json_rows(view), view.schema)


@register(
    "history_scan",
    f"""select {columns_sql(TX_COLUMNS)}, fee_rate, fee_per_weight,
        strftime(transaction_time, '%Y-%m-%d') as event_date from ({fx.ENRICHED_SQL})""",
)
def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "history")
    tx = fx.enriched_transactions(spark, sf_dir).drop("time", "label")
    history.append_history(tx, path, by_date=True)
    stored = history.read_history(spark, path)
    return stored.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


# --- scalar columns -------------------------------------------------------


@register("epoch_to_ts", f"select hash, {SECONDS} as transaction_time from ({fx.TXE_SQL})")
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.event_transactions(spark, sf_dir).drop("transaction_time")
    return records.with_event_time(tx).select("hash", "transaction_time")


@register("ratio_features", f"select hash, fee_rate, fee_per_weight from ({fx.ENRICHED_SQL})")
def ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.enriched_transactions(spark, sf_dir).select("hash", "fee_rate", "fee_per_weight")


@register(
    "guarded_ratios",
    f"""select hash, fee / greatest(size, 1) as fee_rate,
        fee / greatest(weight, 1) as fee_per_weight from ({fx.TXE_SQL})""",
)
def guarded_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    guarded = enrich.with_guarded_ratios(fx.event_transactions(spark, sf_dir))
    return guarded.select("hash", "fee_rate", "fee_per_weight")


@register(
    "input_defaults",
    f"""select coalesce(nullif(hash, ''), 'test_transaction') as hash,
        coalesce(nullif(size, 0), 250) as size, coalesce(nullif(weight, 0), 1000) as weight,
        coalesce(nullif(fee, 0), 5000) as fee,
        coalesce(nullif(inputs_count, 0), 2) as inputs_count,
        coalesce(nullif(outputs_count, 0), 2) as outputs_count,
        coalesce(nullif(input_value, 0), 1000000) as input_value,
        coalesce(nullif(output_value, 0), 995000) as output_value from ({fx.TX_SQL})""",
)
def input_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.order_transactions(spark, sf_dir).drop("time", "transaction_time")
    return records.with_input_defaults(tx)


@register(
    "threshold_flag", f"select hash, anomaly_score > 0.7 as is_anomaly from ({fx.SCORED_SQL})"
)
def threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fx.scored_transactions(spark, sf_dir)
    return enrich.flag_by_threshold(scored, 0.7).select("hash", "is_anomaly")


@register(
    "flag_fallback",
    f"""select hash, case event_id % 3 when 0 then true when 1 then false
        else anomaly_score > 0.5 end as is_anomaly from ({fx.SCORED_SQL})""",
)
def flag_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fx.scored_transactions(spark, sf_dir, "event_id")
    kind = F.col("event_id") % 3
    predicted = scored.withColumn(
        "prediction", F.when(kind == 0, -1.0).when(kind == 1, 1.0).otherwise(F.col("anomaly_score"))
    )
    return enrich.flag_with_fallback(predicted).select("hash", "is_anomaly")


def _explanation_sql(source: str, max_size: int, max_inputs: int, max_outputs: int) -> str:
    return f"""select hash, is_anomaly, case when not is_anomaly
      then 'Transaction appears normal based on its characteristics.'
      else 'Potential anomaly detected: ' || coalesce(nullif(concat_ws('; ',
        case when fee_rate > 100
             then 'Unusually high fee rate (' || printf('%.2f', fee_rate) || ' satoshis/byte)'
             when fee_rate < 1
             then 'Unusually low fee rate (' || printf('%.2f', fee_rate) || ' satoshis/byte)' end,
        case when size > {max_size}
             then 'Unusually large transaction size (' || size || ' bytes)' end,
        case when inputs_count > {max_inputs}
             then 'Unusually high number of inputs (' || inputs_count || ')' end,
        case when outputs_count > {max_outputs}
             then 'Unusually high number of outputs (' || outputs_count || ')' end), ''),
        'Combination of transaction characteristics deviates from normal patterns') end
      as explanation from ({source})"""


@register("explain_anomaly", _explanation_sql(fx.SCORED_SQL, 10000, 50, 50))
def explain_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fx.scored_transactions(spark, sf_dir)
    return enrich.with_explanation(scored).select("hash", "is_anomaly", "explanation")


_EVERY_REASON_SQL = f"select * replace (size % 2 = 0 as is_anomaly) from ({fx.SCORED_SQL})"


@register("explain_all_reasons", _explanation_sql(_EVERY_REASON_SQL, 90, 5, 3))
def explain_all_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits low enough that every reason and combination occurs."""
    scored = fx.scored_transactions(spark, sf_dir)
    flagged = scored.withColumn("is_anomaly", F.col("size") % 2 == 0)
    explained = enrich.with_explanation(flagged, max_size=90, max_inputs=5, max_outputs=3)
    return explained.select("hash", "is_anomaly", "explanation")


@register(
    "rule_check",
    f"""select hash as transaction_hash, cast(case when broken then 1.5 else 0.2 end as double) as anomaly_score,
        broken as is_anomaly, case when broken then
          'Potential anomaly detected: Unusual fee rate (' || printf('%.2f', rate)
          || ' satoshis/byte)'
          else 'Transaction appears normal based on its characteristics.' end as explanation
        from (select hash, rate, rate > 100 or rate < 1 or size > 10000 as broken
              from (select hash, coalesce(nullif(size, 0), 250) as size,
                           coalesce(nullif(fee, 0), 5000) / coalesce(nullif(size, 0), 250) as rate
                    from ({fx.TXE_SQL})))""",
)
def rule_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.rule_check(records.with_input_defaults(fx.event_transactions(spark, sf_dir)))


@register(
    "scatter_projection",
    f"""select size, fee_rate, is_anomaly, hash, fee, inputs_count, outputs_count
        from ({fx.SCORED_SQL})""",
)
def scatter_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.scatter_projection(fx.scored_transactions(spark, sf_dir))


# --- filters --------------------------------------------------------------

_LATEST = "(select max(ts) from events)"


@register(
    "filter_time_range",
    f"""select hash, transaction_time, fee from ({fx.TXE_SQL})
        where transaction_time >= {_LATEST} - interval 24 hours""",
)
def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.event_transactions(spark, sf_dir)
    kept = filters.filter_time_range(tx, "24h", now="latest")
    return kept.select("hash", "transaction_time", "fee")


@register(
    "filter_size_range",
    f"select hash, size, fee from ({fx.TX_SQL}) where size between 100 and 150",
)
def filter_size_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = fx.order_transactions(spark, sf_dir)
    return filters.filter_size_range(tx, 100, 150).select("hash", "size", "fee")


_VIEW_SQL = f"""
select * replace (anomaly_score > 0.8 as is_anomaly) from ({fx.SCORED_SQL})
where transaction_time >= {_LATEST} - interval 12 hours and size between 10 and 80"""


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fx.scored_transactions(spark, sf_dir)
    return filters.filtered_view(scored, "12h", (10, 80), 0.8, now="latest")


@register(
    "filtered_view",
    f"""select hash, transaction_time, size, weight, fee, inputs_count, outputs_count, input_value,
        output_value, fee_rate, fee_per_weight, anomaly_score, is_anomaly from ({_VIEW_SQL})""",
)
def filtered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(spark, sf_dir).drop("time", "label")


@register(
    "filtered_kpis",
    f"""select count(*) as total_transactions, count(*) filter (where is_anomaly) as total_anomalies,
        round(avg(fee_rate), 6) as avg_fee_rate,
        round(cast(sum(size) as double) / count(size), 6) as avg_tx_size from ({_VIEW_SQL})""",
)
def filtered_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = reports.kpi_cards(_filtered(spark, sf_dir)).select(
        "total_transactions", "total_anomalies", "avg_fee_rate", "avg_tx_size"
    )
    return rounded(cards, "avg_fee_rate", "avg_tx_size")


# --- joins ----------------------------------------------------------------


@register(
    "scores_join",
    f"""select {columns_sql(TX_COLUMNS)}, fee_rate, fee_per_weight, anomaly_score, is_anomaly
        from ({fx.SCORED_SQL}) where {ALL_PRESENT}""",
)
def scores_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions exist for complete rows only; the join returns those."""
    original = fx.enriched_transactions(spark, sf_dir).drop("time", "label")
    predicted = features.complete_rows(fx.scored_transactions(spark, sf_dir))
    return joins.attach_scores(original, predicted.select("hash", "anomaly_score", "is_anomaly"))


# --- aggregates -----------------------------------------------------------

_WINDOW_AVERAGES = ["avg_fee", "avg_fee_rate", "avg_size", "avg_inputs", "avg_outputs"]


def _window_sql(source: str, having: str = "") -> str:
    return f"""
select window_start, window_start + interval 10 minutes as window_end,
       count(*) as transaction_count, round(avg(fee), 6) as avg_fee,
       round(avg(fee_rate), 6) as avg_fee_rate, round(avg(size), 6) as avg_size,
       round(avg(inputs_count), 6) as avg_inputs, round(avg(outputs_count), 6) as avg_outputs,
       cast(sum(input_value) as bigint) as total_input_value,
       cast(sum(output_value) as bigint) as total_output_value
from (select *, time_bucket(interval 10 minutes, transaction_time) as window_start
      from ({source})) {having}
group by window_start"""


@register("window_stats", _window_sql(fx.ENRICHED_SQL))
def window_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = window_stats(fx.enriched_transactions(spark, sf_dir))
    return rounded(stats, *_WINDOW_AVERAGES)


@register("window_stats_orders", _window_sql(fx.TX_ENRICHED_SQL))
def window_stats_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over order transactions, whose features may be NULL."""
    stats = window_stats(enrich.with_ratios(fx.order_transactions(spark, sf_dir)))
    return rounded(stats, *_WINDOW_AVERAGES)


def _kpi_sql(source: str) -> str:
    return f"""
select total_transactions, total_anomalies, round(avg_fee_rate, 6) as avg_fee_rate,
       round(avg_tx_size, 6) as avg_tx_size,
       format('{{:,}}', total_transactions) as total_transactions_text,
       format('{{:,}}', total_anomalies) as total_anomalies_text,
       printf('%.2f', avg_fee_rate) as avg_fee_rate_text,
       printf('%.0f', avg_tx_size) as avg_tx_size_text
from (select count(*) as total_transactions, count(*) filter (where is_anomaly) as total_anomalies,
             avg(fee_rate) as avg_fee_rate, cast(sum(size) as double) / count(size) as avg_tx_size
      from ({source}))"""


@register("kpi_cards", _kpi_sql(fx.SCORED_SQL))
def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = reports.kpi_cards(fx.scored_transactions(spark, sf_dir))
    return rounded(cards, "avg_fee_rate", "avg_tx_size")


@register("kpi_cards_anomalies", _kpi_sql(f"select * from ({fx.SCORED_SQL}) where is_anomaly"))
def kpi_cards_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = reports.kpi_cards(fx.scored_transactions(spark, sf_dir), only_anomalies=True)
    return rounded(cards, "avg_fee_rate", "avg_tx_size")


@register(
    "hourly_counts",
    f"""select date_trunc('hour', transaction_time) as hour, is_anomaly, count(*) as count
        from ({fx.SCORED_SQL}) group by all""",
)
def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_counts(fx.scored_transactions(spark, sf_dir))


@register(
    "hourly_counts_anomalies",
    f"""select date_trunc('hour', transaction_time) as hour, is_anomaly, count(*) as count
        from ({fx.SCORED_SQL}) where is_anomaly group by all""",
)
def hourly_counts_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_counts(fx.scored_transactions(spark, sf_dir), only_anomalies=True)


@register(
    "hourly_stacked",
    f"""select date_trunc('hour', transaction_time) as hour,
        count(*) filter (where not is_anomaly) as normal, count(*) filter (where is_anomaly) as anomalous,
        count(*) filter (where is_anomaly is null) as unscored,
        count(*) as total from ({fx.SCORED_SQL}) group by 1""",
)
def hourly_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_stacked(fx.scored_transactions(spark, sf_dir))


@register(
    "hourly_stacked_unscored",
    f"""select date_trunc('hour', transaction_time) as hour,
        count(*) filter (where not is_anomaly) as normal, count(*) filter (where is_anomaly) as anomalous,
        count(*) filter (where is_anomaly is null) as unscored,
        count(*) as total from ({fx.PARTLY_SCORED_SQL}) group by 1""",
)
def hourly_stacked_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_stacked(fx.partly_scored_transactions(spark, sf_dir))


@register("kpi_cards_unscored", _kpi_sql(fx.PARTLY_SCORED_SQL))
def kpi_cards_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = reports.kpi_cards(fx.partly_scored_transactions(spark, sf_dir))
    return rounded(cards, "avg_fee_rate", "avg_tx_size")


@register(
    "recent_table_unscored",
    f"""select strftime(transaction_time, '%Y-%m-%d %H:%M:%S') as time,
        substring(hash, 1, 10) || '...' as hash, format('{{:,}}', size) as size,
        format('{{:,}}', fee) as fee, printf('%.2f', fee_rate) as fee_rate,
        printf('%.2f', anomaly_score) as anomaly_score,
        case when is_anomaly then 'Anomaly' when not is_anomaly then 'Normal' else 'Unscored' end as status
        from (select * from ({fx.PARTLY_SCORED_SQL}) order by transaction_time desc, hash limit 400)""",
)
def recent_table_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enough of the newest rows that some have no score."""
    return reports.recent_table(fx.partly_scored_transactions(spark, sf_dir), rows=400)


@register(
    "score_histogram",
    f"""select bin, round(low + bin * width, 6) as bin_start,
        round(low + (bin + 1) * width, 6) as bin_end, count(*) as count,
        cast(1.0 as double) as threshold
        from (select low, (high - low) / 30 as width,
                cast(least(floor((anomaly_score - low) / (high - low) * 30), 29) as int) as bin
              from (select anomaly_score, min(anomaly_score) over () as low,
                           max(anomaly_score) over () as high from ({fx.SCORED_SQL})))
        group by bin, low, width""",
)
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = reports.score_histogram(fx.scored_transactions(spark, sf_dir))
    return rounded(histogram, "bin_start", "bin_end")


@register(
    "recent_table",
    f"""select strftime(transaction_time, '%Y-%m-%d %H:%M:%S') as time,
        substring(hash, 1, 10) || '...' as hash, format('{{:,}}', size) as size,
        format('{{:,}}', fee) as fee, printf('%.2f', fee_rate) as fee_rate,
        printf('%.2f', anomaly_score) as anomaly_score,
        case when is_anomaly then 'Anomaly' else 'Normal' end as status
        from (select * from ({fx.SCORED_SQL}) order by transaction_time desc, hash limit 10)""",
)
def recent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_table(fx.scored_transactions(spark, sf_dir))


@register(
    "recent_table_anomalies",
    f"""select strftime(transaction_time, '%Y-%m-%d %H:%M:%S') as time,
        substring(hash, 1, 10) || '...' as hash, format('{{:,}}', size) as size,
        format('{{:,}}', fee) as fee, printf('%.2f', fee_rate) as fee_rate,
        printf('%.2f', anomaly_score) as anomaly_score, 'Anomaly' as status
        from (select * from ({fx.SCORED_SQL}) where is_anomaly
              order by transaction_time desc, hash limit 10)""",
)
def recent_table_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_table(fx.scored_transactions(spark, sf_dir), only_anomalies=True)


_METRIC_NAMES = [
    f"avg_{label}_{name}" for name in ("fee", "size", "fee_rate") for label in ("normal", "anomaly")
]
_METRICS_SQL = f"""
select count(*) as num_transactions, count(*) filter (where is_anomaly) as num_anomalies,
       count(*) filter (where is_anomaly) / count(*) * 100 as anomaly_percentage,
       {", ".join(
           f"round(avg({name}) filter (where {condition}), 6) as avg_{label}_{name}"
           for name in ("fee", "size", "fee_rate")
           for label, condition in (("normal", "not is_anomaly"), ("anomaly", "is_anomaly"))
       )}
from ({fx.SCORED_SQL})"""


@register("model_metrics", _METRICS_SQL)
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = reports.model_metrics(fx.scored_transactions(spark, sf_dir))
    return rounded(metrics, *_METRIC_NAMES)


@register(
    "run_metrics_long",
    f"""select key, round(value, 6) as value, 0 as step
        from (unpivot (select num_transactions::double as num_transactions,
                              num_anomalies::double as num_anomalies,
                              anomaly_percentage, {columns_sql(_METRIC_NAMES)}
                       from ({_METRICS_SQL}))
              on columns(*) into name key value value)""",
)
def run_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged to the run tables and read back."""
    path = scratch_path(spark, "runs")
    metrics = reports.model_metrics(fx.scored_transactions(spark, sf_dir))
    params = runlog.params_frame(spark, "report", {"threshold": enrich.DEFAULT_THRESHOLD})
    runlog.append_run(path, params, runlog.metrics_frame(metrics, "report"))
    return rounded(runlog.read_metrics(spark, path).select("key", "value", "step"), "value")


@register(
    "anomalies_csv",
    f"""select hash, size, fee, inputs_count, outputs_count, is_anomaly
        from ({fx.SCORED_SQL}) where is_anomaly""",
)
def anomalies_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported as CSV with a header and read back."""
    path = scratch_path(spark, "anomalies")
    scored = fx.scored_transactions(spark, sf_dir).select(
        "hash", "size", "fee", "inputs_count", "outputs_count", "is_anomaly"
    )
    exports.write_anomalies_csv(scored, path)
    return exports.read_anomalies_csv(scored, path)


# --- features -------------------------------------------------------------


def _present_sql(source: str) -> str:
    return f"select hash, {FEATURE_DOUBLES} from ({source}) where {ALL_PRESENT}"


def _caps_sql(source: str) -> str:
    each = " union all ".join(
        f"select '{name}' as feature, round(quantile_cont({name}, 0.99), 6) as cap from present"
        for name in FEATURES
    )
    return f"with present as ({_present_sql(source)}) {each}"


def _capped_sql(source: str) -> str:
    caps = ", ".join(f"quantile_cont({name}, 0.99) as {name}" for name in FEATURES)
    clipped = ", ".join(f"least(p.{name}, c.{name}) as {name}" for name in FEATURES)
    return f"""select p.hash, {clipped} from ({_present_sql(source)}) p,
      (select {caps} from ({_present_sql(source)})) c"""


@register("feature_select", _present_sql(fx.TX_ENRICHED_SQL))
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = enrich.with_ratios(fx.order_transactions(spark, sf_dir))
    return features.complete_rows(features.select_features(tx, FEATURES, "hash"))


def _feature_rows(tx: DataFrame, *keep: str) -> DataFrame:
    """Complete feature rows, stored because fitting scans them several times."""
    stored = materialize(features.select_features(tx, FEATURES, *keep), "features")
    return features.complete_rows(stored)


@register("feature_caps", _caps_sql(fx.ENRICHED_SQL))
def feature_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feature_rows(fx.enriched_transactions(spark, sf_dir))
    return rounded(features.caps_frame(rows, features.feature_caps(rows)), "cap")


@register("feature_caps_rounds", _caps_sql(fx.ENRICHED_SQL))
def feature_caps_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The caps of a table too large to rank: rounds of sampled cut points and exact counts come first."""
    rows = _feature_rows(fx.enriched_transactions(spark, sf_dir))
    caps = exact_quantiles(rows, FEATURES, CAP_QUANTILE, rankable=50)
    return rounded(features.caps_frame(rows, caps), "cap")


@register("feature_caps_orders", _caps_sql(fx.TX_ENRICHED_SQL))
def feature_caps_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feature_rows(enrich.with_ratios(fx.order_transactions(spark, sf_dir)))
    return rounded(features.caps_frame(rows, features.feature_caps(rows)), "cap")


@register(
    "feature_moments",
    f"with present as ({_present_sql(fx.ENRICHED_SQL)}) "
    + " union all ".join(
        f"select '{name}' as feature, round(avg({name}), 6) as mean, "
        f"round(stddev_pop({name}), 6) as sd from present"
        for name in FEATURES
    ),
)
def feature_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.complete_rows(fx.enriched_transactions(spark, sf_dir))
    return rounded(features.moments_long(features.feature_moments(rows)), "mean", "sd")


@register(
    "feature_moments_merged",
    f"with present as ({_present_sql(fx.ENRICHED_SQL)}) "
    + " union all ".join(
        f"select '{name}' as feature, count(*) as n, round(avg({name}), 6) as mean, "
        f"round(stddev_pop({name}), 6) as sd, max(abs({name})) as max_abs from present"
        for name in FEATURES
    ),
)
def feature_moments_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments from the states of two appends, one state for each event date of an append."""
    path = scratch_path(spark, "states")
    events = fx.slices(fx.table(spark, sf_dir, "events"), 2, displaced=True)
    for k in range(2):
        tx = enrich.with_ratios(fx.as_transactions(events.where(F.col("slice") == k)))
        states.store_states(commits.with_event_date(tx), path)
    merged = states.merged_states(states.read_states(spark, path)).drop("cap")
    return rounded(merged, "mean", "sd")


@register(
    "winsorize_p99", f"select hash, {rounded_sql(FEATURES)} from ({_capped_sql(fx.ENRICHED_SQL)})"
)
def winsorize_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feature_rows(fx.enriched_transactions(spark, sf_dir), "hash")
    return rounded(features.winsorize(rows, features.feature_caps(rows)), *FEATURES)


def _zscore_sql(source: str) -> str:
    moments = ", ".join(
        f"avg({name}) as {name}_mean, coalesce(nullif(stddev_pop({name}), 0), 1) as {name}_sd"
        for name in FEATURES
    )
    scaled = ", ".join(f"round(({n} - {n}_mean) / {n}_sd, 6) as {n}" for n in FEATURES)
    return f"""with clipped as materialized ({_capped_sql(source)})
      select hash, {scaled} from clipped, (select {moments} from clipped)"""


@register("zscore_features", _zscore_sql(fx.ENRICHED_SQL))
def zscore_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feature_rows(fx.enriched_transactions(spark, sf_dir), "hash")
    fitted = features.Preprocessor.fit(rows)
    return rounded(fitted.transform(rows, "hash"), *FEATURES)


@register(
    "maxabs_scale",
    f"""select hash, {", ".join(f"{n} / nullif(max(abs({n})) over (), 0) as {n}" for n in FEATURES)}
        from (select hash, {FEATURE_DOUBLES} from ({fx.ENRICHED_SQL}))""",
)
def maxabs_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.maxabs_scale(fx.enriched_transactions(spark, sf_dir), FEATURES, "hash")


# --- operational metrics --------------------------------------------------


@register(
    "metric_counter",
    f"""select case when is_anomaly then 'anomalous' else 'normal' end as status,
        count(*) as value from ({fx.SCORED_SQL}) group by 1""",
)
def metric_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.processed_counter(fx.scored_transactions(spark, sf_dir))


@register(
    "metric_counter_unscored",
    f"""select case when is_anomaly then 'anomalous' else 'normal' end as status, count(*) as value
        from ({fx.PARTLY_SCORED_SQL}) where is_anomaly is not null group by 1""",
)
def metric_counter_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.processed_counter(fx.partly_scored_transactions(spark, sf_dir))


@register(
    "metric_latest_score",
    f"""select anomaly_score as value from ({fx.SCORED_SQL})
        order by transaction_time desc, hash desc limit 1""",
)
def metric_latest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.latest_score(fx.scored_transactions(spark, sf_dir))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values, scaled to seconds, as observed durations."""
    events = fx.table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("endpoint"), (F.col("value") / 10).alias("seconds")
    )


_OBSERVED_SQL = "select event_type as endpoint, value / 10 as seconds from events"


@register(
    "metric_le_histogram",
    "select n as count, round(total, 6) as sum, le, bucket_count from (select count(*) as n, "
    "sum(seconds) as total, "
    + ", ".join(f"count(*) filter (where seconds <= {b}) as b{i}" for i, b in enumerate(monitoring.LATENCY_BUCKETS))
    + f" from ({_OBSERVED_SQL})), lateral (values "
    + ", ".join(f"('{b}', b{i})" for i, b in enumerate(monitoring.LATENCY_BUCKETS))
    + ", ('+Inf', n)) buckets(le, bucket_count)",
)
def metric_le_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monitoring.latency_histogram(_observed(spark, sf_dir), "seconds"), "sum")


@register(
    "metric_summary",
    f"""select endpoint, count(seconds) as count, round(sum(seconds), 6) as sum
        from ({_OBSERVED_SQL}) group by endpoint""",
)
def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monitoring.latency_summary(_observed(spark, sf_dir), "seconds"), "sum")


@register(
    "metric_lag",
    """select event_id % 4 as partition,
       max(event_id // 4) - coalesce(max(event_id // 4) filter (where ts <= timestamp '2024-01-25'),
                                     min(event_id // 4) - 1) as lag
       from events group by 1""",
)
def metric_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    offsets = fx.table(spark, sf_dir, "events").select(
        (F.col("event_id") % 4).alias("partition"), F.expr("event_id div 4").alias("offset"), "ts"
    )
    handled = F.col("ts") <= F.expr("timestamp_ntz '2024-01-25'")
    return monitoring.consumer_lag(offsets, handled)


@register("metric_table_bytes")
def metric_table_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.table_bytes(spark, f"{sf_dir}/events.parquet")


@register(
    "metric_errors",
    f"""select label, count(*) filter (where not ({ALL_PRESENT})) as value from ({fx.SCORED_SQL})
        group by label""",
)
def metric_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a missing feature get no score."""
    scored = fx.scored_transactions(spark, sf_dir)
    complete = F.lit(True)
    for name in FEATURES:
        complete = complete & F.col(name).isNotNull()
    attempted = scored.withColumn("anomaly_score", F.when(complete, F.col("anomaly_score")))
    return monitoring.prediction_errors(attempted, "label")


# --- streaming ------------------------------------------------------------


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    # A plain path of a stream must be a folder; a glob may also name one file.
    events = messages.file_stream(spark, f"{sf_dir}/events.parque[t]", "parquet", schema)
    sent = records.to_messages(fx.as_transactions(events))
    return sent.select(F.col("value").cast("binary").alias("value"))


_STREAM_SQL = f"""select * replace ({SECONDS} as transaction_time) from ({fx.ENRICHED_SQL})"""


@register(
    "stream_raw_enrich",
    f"select {columns_sql(TX_COLUMNS)}, fee_rate, fee_per_weight from ({_STREAM_SQL})",
)
def stream_raw_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-history")
    tx = pipelines.enriched(_message_stream(spark, sf_dir))
    query = pipelines.start_history(tx, f"{path}/table", f"{path}/checkpoint", trigger=None)
    query.awaitTermination()
    return history.read_history(spark, f"{path}/table").drop("processing_time", "row_id")


@register(
    "stream_window_stats",
    _window_sql(
        _STREAM_SQL,
        "where window_start + interval 10 minutes <= "
        f"(select max({SECONDS}) - interval 10 minutes from ({fx.TXE_SQL}))",
    ),
)
def stream_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-stats")
    tx = pipelines.enriched(_message_stream(spark, sf_dir))
    query = pipelines.start_window_stats(tx, f"{path}/table", f"{path}/checkpoint", trigger=None)
    query.awaitTermination()
    return rounded(history.read_history(spark, f"{path}/table"), *_WINDOW_AVERAGES)


_SLICES = 6


def _sliced(spark: SparkSession, sf_dir: str, displaced: bool = False) -> DataFrame:
    return materialize(fx.slices(fx.table(spark, sf_dir, "events"), _SLICES, displaced), "slices")


def _event_stream(spark: SparkSession, sf_dir: str, folder: str, files: int) -> DataFrame:
    """Events of a folder, one slice of ``files`` files a batch."""
    schema = fx.table(spark, sf_dir, "events").schema
    return messages.file_stream(spark, folder, "parquet", schema, maxFilesPerTrigger=str(files))


def _enriched_events(events: DataFrame) -> DataFrame:
    return pipelines.enriched(records.to_messages(fx.as_transactions(events)))


@register(
    "history_mixed_writes",
    f"""select {columns_sql(TX_COLUMNS)}, fee_rate, fee_per_weight,
        strftime(transaction_time, '%Y-%m-%d') as event_date from ({_STREAM_SQL})""",
)
def history_mixed_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table from a stream, appends by date and without, and a compaction in between."""
    path = scratch_path(spark, "mixed")
    events = _sliced(spark, sf_dir)
    files = fx.files_a_slice(events)

    def stream(wanted: range) -> None:
        fx.land_slices(events, f"{path}/landed", wanted, files)
        tx = _enriched_events(_event_stream(spark, sf_dir, f"{path}/landed", files))
        pipelines.start_history(
            tx, f"{path}/table", f"{path}/checkpoint", trigger=None, by_date=True
        ).awaitTermination()

    def append(k: int, by_date: bool) -> None:
        rows = _enriched_events(events.where(F.col("slice") == k).drop("slice"))
        history.append_history(rows, f"{path}/table", by_date=by_date)

    stream(range(2))
    append(2, by_date=True)
    append(3, by_date=False)
    commits.compact(spark, f"{path}/table", by_date=True)
    stream(range(4, 5))
    append(5, by_date=False)
    stored = history.read_history(spark, f"{path}/table").drop("processing_time", "row_id")
    return stored.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


@register(
    "stream_late_rows",
    f"""with m as (
          select hash, {SECONDS} as transaction_time, {fx.slice_sql(_SLICES, True)} as batch from ({fx.TXE_SQL})),
        b as (select batch, max(transaction_time) as latest from m group by batch),
        w as (select k.batch, (select max(latest) from b where b.batch <= k.batch - 2) - interval 10 minutes as watermark
              from b k),
        e as (select *, time_bucket(interval 10 minutes, transaction_time) + interval 10 minutes as window_end from m)
        select hash, transaction_time, window_end, cast(batch as bigint) as batch
        from e join w using (batch) where window_end <= watermark""",
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows below the watermark of their batch, over several batches of which each tenth row comes late."""
    path = scratch_path(spark, "stream-late")
    events = _sliced(spark, sf_dir, True)
    files = fx.files_a_slice(events)
    fx.land_slices(events, f"{path}/landed", range(_SLICES), files)
    tx = _enriched_events(_event_stream(spark, sf_dir, f"{path}/landed", files))
    live.start_late_rows(tx, f"{path}/late", f"{path}/checkpoint", trigger=None).awaitTermination()
    return live.read_late_rows(spark, f"{path}/late").select("hash", "transaction_time", "window_end", "batch")


@register("stream_restart", ORACLES["stream_window_stats"])
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window statistics of a stream that is stopped after two batches, breaks off in the fourth and is resumed."""
    path = scratch_path(spark, "stream-restart")
    events = _sliced(spark, sf_dir)
    files = fx.files_a_slice(events)

    def run(broken: bool = False) -> None:
        tx = _enriched_events(_event_stream(spark, sf_dir, f"{path}/landed", files))
        if broken:
            last = events.where(F.col("slice") == 3).agg(F.max("event_id")).first()[0]
            failure = F.raise_error(F.lit("broken off")).cast("bigint")
            tx = tx.withColumn("fee", F.when(F.col("hash") == f"tx_{last}", failure).otherwise(F.col("fee")))
        pipelines.start_window_stats(tx, f"{path}/table", f"{path}/checkpoint", trigger=None).awaitTermination()

    fx.land_slices(events, f"{path}/landed", range(2), files)
    run()
    fx.land_slices(events, f"{path}/landed", range(2, _SLICES), files)
    try:
        run(broken=True)
    except StreamingQueryException:
        run()
    else:
        raise AssertionError("the broken run has not ended with an error")
    return rounded(history.read_history(spark, f"{path}/table"), *_WINDOW_AVERAGES)


# --- anomaly model --------------------------------------------------------


def _stored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions identified by their hash, as a table, which is what training expects to read."""
    tx = fx.enriched_transactions(spark, sf_dir).withColumn("row_id", F.col("hash"))
    return materialize(tx, "transactions")


@register("iforest_fit", forest_sql.nodes_sql(fx.ENRICHED_SQL))
def iforest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node table of the fitted forest."""
    model, _ = fit_isolation_forest(_stored_transactions(spark, sf_dir))
    return rounded(spark.createDataFrame(model.nodes, NODE_SCHEMA), "threshold")


@register(
    "iforest_shape",
    f"""select cast(tree as int) as tree_id, rows, rows as leaf_rows, true as shallow
        from (select least(256, count(*)) as rows from ({fx.ENRICHED_SQL}) where {ALL_PRESENT}), range(100) r(tree)""",
)
def iforest_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every tree: its root holds the sample, its leaves share it, none lies too deep."""
    model, _ = fit_isolation_forest(_stored_transactions(spark, sf_dir))
    nodes = spark.createDataFrame(model.nodes, NODE_SCHEMA)
    return nodes.groupBy("tree_id").agg(
        F.max(F.when(F.col("node_id") == 0, F.col("n"))).cast("bigint").alias("rows"),
        F.sum(F.when(F.col("feature").isNull(), F.col("n"))).alias("leaf_rows"),
        (F.max("depth") <= 8).alias("shallow"),
    )


@register("iforest_score", forest_sql.scores_sql(fx.ENRICHED_SQL))
def iforest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all rows; each is scored once, and incomplete ones have none."""
    tx = _stored_transactions(spark, sf_dir)
    _, scored = fit_isolation_forest(tx, keep=("hash",))
    missing = F.lit(False)
    for name in FEATURES:
        missing = missing | F.col(name).isNull()
    unscored = tx.where(missing).select(
        "hash", F.lit(None).cast("double").alias("anomaly_score"), F.lit(None).cast("boolean").alias("is_anomaly")
    )
    return rounded(scored.unionByName(unscored), "anomaly_score")


@register(
    "model_latest_version",
    f"""select cast(2 as int) as version, cast(100 as int) as n_trees, cast(least(256, count(*)) as int) as psi,
        cast(42 as bigint) as seed, cast(0.01 as double) as contamination, count(*) as trained_rows
        from ({fx.ENRICHED_SQL}) where {ALL_PRESENT}""",
)
def model_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "models")
    model, _ = fit_isolation_forest(_stored_transactions(spark, sf_dir))
    registry.save_model(spark, path, model)
    registry.save_model(spark, path, model)
    return registry.latest_params(spark, path).select(
        "version", "n_trees", "psi", "seed", "contamination", "trained_rows"
    )


def _known_forest(spark: SparkSession, sf_dir: str, path: str) -> AnomalyModel:
    """A forest whose splits are exact quantiles, fitted to an offset, saved and loaded.

    Tree i splits feature i at its median, then that feature at its lower quartile on the
    left and the next feature at its upper quartile on the right.
    """
    rows = features.complete_rows(
        materialize(fx.enriched_transactions(spark, sf_dir).select(*FEATURES), "features")
    )
    total = rows.count()
    low, middle, high = (exact_quantiles(rows, FEATURES, q, rows=total) for q in (0.25, 0.5, 0.75))
    nodes = []
    for tree, name in enumerate(FEATURES):
        after = (tree + 1) % len(FEATURES)
        nodes += [
            (tree, 0, tree, float(middle[name]), 1, 2, 120, 0),
            (tree, 1, tree, float(low[name]), 3, 4, 96, 1),
            (tree, 2, after, float(high[FEATURES[after]]), 5, 6, 24, 1),
            *[(tree, 3 + k, None, None, None, None, n, 2) for k, n in enumerate(_LEAF_ROWS)],
        ]
    width = len(FEATURES)
    plain = features.Preprocessor(FEATURES, [None] * width, [0.0] * width, [1.0] * width)
    model = AnomalyModel(plain, nodes, width, 256, 0, 0.01)
    offset = _score_quantile(rows, model, 0.99)
    registry.save_model(spark, path, dataclasses.replace(model, offset=offset))
    return registry.load_model(spark, path)


def _score_quantile(rows: DataFrame, model: AnomalyModel, q: float) -> float | None:
    """Exact quantile of the raw scores, which are stored so that its scans do not score again."""
    raw = materialize(rows.select(model.raw_score(rows.sparkSession).alias("raw")), "raw")
    return exact_quantiles(raw, ["raw"], q)["raw"]


_LEAF_ROWS = (64, 32, 16, 8)


def _known_raw_sql() -> str:
    paths = [f"{2 + average_path(n)!r}" for n in _LEAF_ROWS]
    trees = []
    for tree, name in enumerate(FEATURES):
        after = FEATURES[(tree + 1) % len(FEATURES)]
        trees.append(
            f"case when {name} <= m_{name} then case when {name} <= l_{name} then {paths[0]} else {paths[1]} end "
            f"else case when {after} <= h_{after} then {paths[2]} else {paths[3]} end end"
        )
    return f"pow(2, -({' + '.join(trees)}) / ({len(FEATURES)} * {average_path(256)!r}))"


_CUTS_SQL = ", ".join(
    f"quantile_cont({name}, {q}) as {letter}_{name}"
    for name in FEATURES
    for letter, q in (("l", 0.25), ("m", 0.5), ("h", 0.75))
)
_KNOWN_FOREST_SQL = f"""
with present as materialized (select hash, {FEATURE_DOUBLES} from ({fx.ENRICHED_SQL}) where {ALL_PRESENT}),
cuts as (select {_CUTS_SQL} from present),
bound as (select quantile_cont(raw, 0.99) as offset_ from (select {_known_raw_sql()} as raw from present, cuts)),
guarded as (
  select * replace (cast(fee as double) / greatest(size, 1) as fee_rate,
                    cast(fee as double) / greatest(weight, 1) as fee_per_weight) from ({fx.ENRICHED_SQL})),
scored as (select guarded.*, {_known_raw_sql()} - offset_ as score from guarded, cuts, bound)
select hash as transaction_hash, round(score, 6) as anomaly_score, score > 1e-12 as is_anomaly from scored"""


@register("known_forest_report", _KNOWN_FOREST_SQL)
def known_forest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, offset and flag of a registered forest, for all transactions."""
    model = _known_forest(spark, sf_dir, scratch_path(spark, "models"))
    report = score_report(fx.event_transactions(spark, sf_dir), model)
    return _clear_flags(report)


@register("known_forest_stream", _KNOWN_FOREST_SQL)
def known_forest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the message stream."""
    path = scratch_path(spark, "stream-scores")
    model = _known_forest(spark, sf_dir, f"{path}/models")
    tx = pipelines.enriched(_message_stream(spark, sf_dir))
    query = pipelines.start_scores(tx, model, f"{path}/table", f"{path}/checkpoint", trigger=None)
    query.awaitTermination()
    return _clear_flags(history.read_history(spark, f"{path}/table"))


#: Raw scores of the known forest for all events, with two offsets: of version 1 and of version 2.
_KNOWN_CTES = f"""
with present as materialized (select hash, {FEATURE_DOUBLES} from ({fx.ENRICHED_SQL}) where {ALL_PRESENT}),
cuts as (select {_CUTS_SQL} from present),
bound as (select quantile_cont(raw, 0.99) as first_, quantile_cont(raw, 0.95) as second_
          from (select {_known_raw_sql()} as raw from present, cuts)),
guarded as (
  select * replace (cast(fee as double) / greatest(size, 1) as fee_rate,
                    cast(fee as double) / greatest(weight, 1) as fee_per_weight) from ({fx.ENRICHED_SQL})),
known as materialized (
  select guarded.*, value / 10 as seconds, case when {ALL_PRESENT} then {_known_raw_sql()} end as raw, first_, second_
  from guarded join (select event_id, value from events) using (event_id), cuts, bound)"""


@register(
    "stream_score_reload",
    f"""{_KNOWN_CTES},
    versioned as (
      select *, case when {fx.slice_sql(_SLICES)} < 3 then 1 else 2 end as model_version from known),
    scored as (select *, raw - case when model_version = 1 then first_ else second_ end as score from versioned)
    select hash as transaction_hash, round(score, 6) as anomaly_score, score > 1e-12 as is_anomaly, model_version from scored""",
)
def stream_score_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of a stream during which a second version of the model is registered."""
    path = scratch_path(spark, "stream-reload")
    events = _sliced(spark, sf_dir)
    files = fx.files_a_slice(events)
    first = _known_forest(spark, sf_dir, f"{path}/models")

    def run(wanted: range) -> None:
        fx.land_slices(events, f"{path}/landed", wanted, files)
        tx = _enriched_events(_event_stream(spark, sf_dir, f"{path}/landed", files))
        live.start_newest_scores(
            tx, f"{path}/models", f"{path}/table", f"{path}/checkpoint", trigger=None
        ).awaitTermination()

    run(range(3))
    rows = features.complete_rows(
        materialize(fx.enriched_transactions(spark, sf_dir).select(*FEATURES), "features")
    )
    offset = _score_quantile(rows, first, 0.95)
    registry.save_model(spark, f"{path}/models", dataclasses.replace(first, offset=offset))
    run(range(3, _SLICES))
    stored = history.read_history(spark, f"{path}/table")
    return _clear_flags(stored, "model_version")


def _scored_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """All events as a stream of several batches, scored by the known forest, with observed durations."""
    model = _known_forest(spark, sf_dir, f"{path}/models")
    events = _sliced(spark, sf_dir, True)
    files = fx.files_a_slice(events)
    fx.land_slices(events, f"{path}/landed", range(_SLICES), files)
    landed = _event_stream(spark, sf_dir, f"{path}/landed", files)
    tx = fx.as_transactions(landed, (F.col("value") / 10).alias("seconds"))
    return model.score(enrich.with_guarded_ratios(tx))


_OBSERVED_COUNTS = {
    "normal": "count(*) filter (where raw - first_ <= 1e-12)",
    "anomalous": "count(*) filter (where raw - first_ > 1e-12)",
    "errors": "count(*) filter (where raw is null)",
    **{f"le_{b}": f"count(*) filter (where seconds <= {b})" for b in monitoring.LATENCY_BUCKETS},
    "seconds_count": "count(seconds)",
    "seconds_sum": "sum(seconds)",
}


@register(
    "stream_observed_metrics",
    f"{_KNOWN_CTES} "
    + " union all ".join(
        f"select '{name}' as metric, round(({value})::double, 6) as value from known"
        for name, value in _OBSERVED_COUNTS.items()
    ),
)
def stream_observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters, error count and latency buckets that a listener stored batch by batch, added up."""
    path = scratch_path(spark, "stream-observed")
    scored = _scored_stream(spark, sf_dir, path)
    listener = live.BatchMetrics(spark, f"{path}/metrics", "observed")
    spark.streams.addListener(listener)
    try:
        observed = scored.observe("transactions", *live.observed_columns(F.col("seconds")))
        pipelines.start_commits(
            observed.select("hash", "anomaly_score", "is_anomaly"), f"{path}/table", f"{path}/checkpoint", None, False, "observed"
        ).awaitTermination()
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    stored = live.read_batch_metrics(spark, f"{path}/metrics")
    each = stored.select(F.explode("observed").alias("metric", "value"))
    return rounded(each.groupBy("metric").agg(F.sum("value").alias("value")), "value")


@register(
    "stream_latest_score",
    f"""{_KNOWN_CTES}
    select label, round(raw - first_, 6) as value from known
    qualify row_number() over (partition by label order by transaction_time desc, hash desc) = 1""",
)
def stream_latest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest score by label from a stream whose rows come out of order."""
    path = scratch_path(spark, "stream-latest")
    scored = _scored_stream(spark, sf_dir, path)
    live.start_latest_scores(scored, f"{path}/table", f"{path}/checkpoint", trigger=None).awaitTermination()
    return rounded(live.read_latest_scores(spark, f"{path}/table"), "value")


def _clear_flags(report: DataFrame, *more: str) -> DataFrame:
    """Scores at the offset differ from it by rounding only, which mustn't decide the flag."""
    return report.select(
        "transaction_hash",
        F.round("anomaly_score", DIGITS).alias("anomaly_score"),
        (F.col("anomaly_score") > 1e-12).alias("is_anomaly"),
        *more,
    )


_TRAIN_SQL = f"""{forest_sql.trained(fx.ENRICHED_SQL)}
select key, round(value, 6) as value
from (unpivot (
  select count(*)::double as num_transactions, (count(*) filter (where is_anomaly))::double as num_anomalies,
         count(*) filter (where is_anomaly) / count(*) * 100 as anomaly_percentage,
         {", ".join(
             f"avg({name}) filter (where {condition}) as avg_{label}_{name}"
             for name in ("fee", "size", "fee_rate")
             for label, condition in (("normal", "not is_anomaly"), ("anomaly", "is_anomaly"))
         )}
  from flagged) on columns(*) into name key value value)"""


@register("train_report", _TRAIN_SQL)
def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History table → model, metrics, registry and export; returns the metrics."""
    path = scratch_path(spark, "train")
    tx = fx.enriched_transactions(spark, sf_dir).drop("time", "label")
    history.append_history(tx.withColumn("row_id", F.col("hash")), f"{path}/history")
    run = jobs.train(spark, f"{path}/history", path)
    return rounded(run.metrics.select("key", "value"), "value")


@register(
    "train_run_log",
    f"""select 'contamination' as key, '0.01' as value union all
        select 'n_estimators', '100' union all select 'random_state', '42' union all
        select 'num_transactions', cast(count(*) as varchar)
        from ({fx.ENRICHED_SQL}) where {ALL_PRESENT}""",
)
def train_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run logs: its parameters and the rows it was trained on."""
    path = scratch_path(spark, "train")
    run = jobs.train_on(_stored_transactions(spark, sf_dir), path)
    rows = run.metrics.where("key = 'num_transactions'")
    rows = rows.select("key", F.col("value").cast("bigint").cast("string").alias("value"))
    return runlog.read_params(spark, f"{path}/runs").select("key", "value").unionByName(rows)


_GUARDED_SQL = f"""select * replace (cast(fee as double) / greatest(size, 1) as fee_rate,
                        cast(fee as double) / greatest(weight, 1) as fee_per_weight) from ({fx.ENRICHED_SQL})"""
# ``_explanation_sql`` selects from a subquery, so the verdicts come as a table of their own.
_VERDICT_SQL = f"""{forest_sql.verdicts(fx.ENRICHED_SQL, _GUARDED_SQL)},
told as ({_explanation_sql("select * replace (fee / nullif(size, 0) as fee_rate) from verdict", 10000, 50, 50)})
select hash as transaction_hash, round(anomaly_score, 6) as anomaly_score, is_anomaly,
       case when anomaly_score is not null then explanation end as explanation
from verdict join (select hash, explanation from told) using (hash)"""


@register("score_report", _VERDICT_SQL)
def score_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = _stored_transactions(spark, sf_dir)
    model, _ = fit_isolation_forest(tx)
    return rounded(score_report(tx, model), "anomaly_score")


@register("stream_score", _VERDICT_SQL)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-scores")
    model, _ = fit_isolation_forest(_stored_transactions(spark, sf_dir))
    tx = pipelines.enriched(_message_stream(spark, sf_dir))
    query = pipelines.start_scores(
        tx, model, f"{path}/table", f"{path}/checkpoint", trigger=None
    )
    query.awaitTermination()
    return rounded(history.read_history(spark, f"{path}/table"), "anomaly_score")
