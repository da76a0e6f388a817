"""Registered queries and the SQL each one must agree with.

``entry`` runs the flagship query; ``queries`` maps a name to a function of (spark, table folder);
``oracle_sql`` gives the same result as SQL for DuckDB over the same tables.
"""

from __future__ import annotations

import functools
import importlib
import os
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.functions.text import value_cleaner
from tiermill.operators.averages import enriched_averages, group_averages, latest_per_key
from tiermill.operators.columns import cast_columns, clean_columns, dedupe, keep_numeric, map_columns
from tiermill.operators.joins import enrich
from tiermill.operators.messages import decode, encode, string_schema
from tiermill.plans.history import compact_history, latest_state
from tiermill.plans.medallion import Dataset, Report, refine, run_medallion
from tiermill.plans.tables import publish_changes, valid_dimension
from tiermill.sinks.files import message_folder_sink, parquet_sink, preview, write_messages
from tiermill.sources.csv_types import land_csv
from tiermill.sources.cuts import balanced_conditions
from tiermill.sources.files import read_parquet, working_folder
from tiermill.sources.topics import read_message_folder
from tiermill.streaming.following import FollowingQuery, Generation, HeldDimension, KeySketch, files_version
from tiermill.streaming.pipelines import average_messages, start_updates, tail_to_files

# The operators for training data, present only if their subpackage can be imported, with all that it needs.
try:
    llm_queries = importlib.import_module("tiermill.llm.queries")
except ModuleNotFoundError as missing:
    if missing.name not in ("tiermill.llm", "tiermill.llm.queries"):
        warnings.warn(f"the queries for training data are left out: {missing}", stacklevel=2)
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
KEYS = ["event_type", "c_mktsegment", "c_nationkey"]
MICRO_BATCHES = 4
RUN_TIME = "2024-05-06 07:08:09"
EVENT_COLUMNS = "event_id bigint, ts string, user_id bigint, event_type string, value {}, props string"
CUSTOMER_COLUMNS = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal {}, c_mktsegment string"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


# --- batch averages -------------------------------------------------------------------------------


def _event_averages(events: DataFrame, customer: DataFrame, reduce_first: bool | None = None) -> DataFrame:
    return enriched_averages(
        events,
        customer,
        on=("user_id", "c_custkey"),
        fact_keys=["event_type"],
        dimension_keys=["c_mktsegment", "c_nationkey"],
        fact_measures={"avg_value": "value"},
        dimension_measures={"avg_acctbal": "c_acctbal"},
        exact_scale=2,
        stamp=None,
        reduce_first=reduce_first,
    )


def gold_avg_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_averages(_table(spark, sf_dir, "events"), _table(spark, sf_dir, "customer"))


def gold_avg_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for two large sides."""
    return _event_averages(_table(spark, sf_dir, "events"), _table(spark, sf_dir, "customer"), reduce_first=True)


def gold_avg_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_averages(
        _table(spark, sf_dir, "lineitem"),
        _table(spark, sf_dir, "part"),
        on=("l_partkey", "p_partkey"),
        fact_keys=["l_returnflag", "l_linestatus"],
        dimension_keys=["p_type", "p_brand"],
        fact_measures={"avg_price": "l_extendedprice", "avg_quantity": "l_quantity"},
        dimension_measures={"avg_retail": "p_retailprice"},
        exact_scale=2,
        stamp=None,
    )


def gold_avg_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers repeat on both sides."""
    return enriched_averages(
        _table(spark, sf_dir, "events"),
        _table(spark, sf_dir, "orders"),
        on=("user_id", "o_custkey"),
        fact_keys=["event_type"],
        dimension_keys=["o_orderpriority"],
        fact_measures={"avg_value": "value"},
        dimension_measures={"avg_total": "o_totalprice"},
        exact_scale=2,
        stamp=None,
    )


def gold_avg_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default form, with the time of the run."""
    return enriched_averages(
        _table(spark, sf_dir, "lineitem"),
        _table(spark, sf_dir, "part"),
        on=("l_partkey", "p_partkey"),
        fact_keys=["l_returnflag"],
        dimension_keys=["p_type"],
        dimension_measures={"avg_size": "p_size"},
        run_ts=F.lit(RUN_TIME).cast("timestamp_ntz"),
    )


def _status_or_null() -> Column:
    return F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))


def avg_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumn("status", _status_or_null())
    return group_averages(
        orders, ["status", "o_orderpriority"], {"avg_total": "o_totalprice"}, exact_scale=2, stamp=None
    )


# --- joins and projections ------------------------------------------------------------------------


def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(
        _table(spark, sf_dir, "events"),
        _table(spark, sf_dir, "customer"),
        on=("user_id", "c_custkey"),
        fact_columns=["event_id", "user_id", "event_type", "value"],
        dimension_columns=["c_mktsegment", "c_nationkey", "c_acctbal"],
    )


def project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(
        _table(spark, sf_dir, "orders"),
        _table(spark, sf_dir, "customer"),
        on=("o_custkey", "c_custkey"),
        fact_columns={"order_id": "o_orderkey", "total": "o_totalprice"},
        dimension_columns={"buyer": "c_name", "segment": "c_mktsegment"},
        key_type="string",
    )


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def balanced_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read by conditions, as a database would be: one per part, of about equally many rows."""
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    parts = [events.filter(c) for c in balanced_conditions(events, "user_id", 8, then="event_id")]
    return functools.reduce(DataFrame.unionByName, parts)


def cast_type_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return cast_columns(events, {"event_id": "string", "user_id": "double"})


# --- cleaning -------------------------------------------------------------------------------------


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_columns(_table(spark, sf_dir, "documents"), ["text", "source"])


def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("text", "lang", "source")
    return dedupe(clean_columns(documents, ["text", "source"]))


def clean_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", _status_or_null().alias("status"), F.col("o_orderpriority").alias("priority")
    )
    return clean_columns(orders, ["status", "priority"])


def clean_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", _status_or_null().alias("status"))
    return clean_columns(orders, ["status"], null_token=None)


def udf_map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return map_columns(orders, ["o_orderpriority"], value_cleaner())


def _dirty_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    dirty = (
        F.when(size % 7 == 0, F.lit("na"))
        .when(size % 7 == 1, F.concat(size.cast("string"), F.lit("-10")))
        .when(size % 7 == 2, F.lit(None))
        .otherwise(size.cast("string"))
    )
    return _table(spark, sf_dir, "part").withColumn("size_text", dirty)


def numeric_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _dirty_part(spark, sf_dir).select("p_partkey", "size_text", "p_retailprice")
    return cast_columns(keep_numeric(part, ["size_text", "p_retailprice"]), {"size_text": "double"})


def valid_dimension_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _dirty_part(spark, sf_dir).select("p_partkey", "p_type", "size_text", "p_retailprice")
    return valid_dimension(part, "p_partkey", ["size_text", "p_retailprice"])


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _dirty_part(spark, sf_dir).select("p_name", "p_type", "size_text")
    return refine(part, ["p_name", "p_type"], ["size_text"])


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _dirty_part(spark, sf_dir).select("p_partkey", "p_name", "p_type", "size_text")
    return preview(refine(part, ["p_name", "p_type"], ["size_text"]), order_by="p_partkey")


# --- messages -------------------------------------------------------------------------------------


def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_table(spark, sf_dir, "customer"), "c_custkey")


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return decode(encode(events, "user_id"), string_schema(events.columns))


def publish_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published as a folder of messages, read back as the stream's source would see them."""
    folder = working_folder(spark, "topic")
    write_messages(encode(_table(spark, sf_dir, "customer"), "c_custkey"), folder)
    return _sent(spark, folder)


def publish_second_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second publication sends after a tenth of the rows has changed and some are gone."""
    folder = working_folder(spark, "publication")
    customer = _table(spark, sf_dir, "customer")
    changed = customer.filter("c_custkey % 17 > 0").withColumn(
        "c_name", F.expr("CASE WHEN c_custkey % 10 = 0 THEN concat(c_name, '!') ELSE c_name END")
    )
    for n, table in enumerate((customer, changed)):
        publish_changes(table, "c_custkey", lambda m: write_messages(m, f"{folder}/{n}"), f"{folder}/state", deletions=True)
    return _sent(spark, f"{folder}/1")


def _sent(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, folder).select("key", F.col("value").cast("string").alias("value"))


# --- stored layers --------------------------------------------------------------------------------


def csv_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "bronze")
    _table(spark, sf_dir, "customer").write.csv(f"{folder}/customer.csv", header=True)
    land_csv(spark, f"{folder}/customer.csv", f"{folder}/customer.parquet")
    return cast_columns(read_parquet(spark, f"{folder}/customer.parquet"), {"c_custkey": "bigint"})


def medallion_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "medallion")
    for name in ("events", "customer"):
        _table(spark, sf_dir, name).write.csv(f"{folder}/landing/{name}.csv", header=True)
    return run_medallion(spark, f"{folder}/landing", f"{folder}/lake", _event_report("double")).drop("timestamp")


def medallion_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files in which a third of the events come twice and a tenth of the numbers are none."""
    folder = working_folder(spark, "medallion")
    events, customer = _table(spark, sf_dir, "events"), _table(spark, sf_dir, "customer")
    events = events.unionByName(events.filter("event_id % 3 = 0"))
    events = events.withColumn("value", F.expr("CASE WHEN event_id % 10 = 0 THEN 'na' ELSE string(value) END"))
    customer = customer.withColumn("c_acctbal", F.expr("CASE WHEN c_custkey % 10 = 0 THEN '-' ELSE string(c_acctbal) END"))
    events.write.csv(f"{folder}/landing/events.csv", header=True)
    customer.write.csv(f"{folder}/landing/customer.csv", header=True)
    return run_medallion(spark, f"{folder}/landing", f"{folder}/lake", _event_report("string")).drop("timestamp")


def medallion_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline run twice, each layer of the second run replacing that of the first when it was complete; types are found."""
    folder = working_folder(spark, "medallion")
    events, customer = _table(spark, sf_dir, "events"), _table(spark, sf_dir, "customer")
    for n, landed in enumerate((events.filter("event_id % 2 = 0"), events)):
        landed.write.csv(f"{folder}/landing-{n}/events.csv", header=True)
        customer.write.csv(f"{folder}/landing-{n}/customer.csv", header=True)
        gold = run_medallion(spark, f"{folder}/landing-{n}", f"{folder}/lake", _event_report(None), versioned=True)
    return gold.drop("timestamp")


def _event_report(number: str | None) -> Report:
    """Averages of events and customers whose files hold their numbers as ``number``, or whose types are to be found."""
    events, customer = (columns.format(number) if number else None for columns in (EVENT_COLUMNS, CUSTOMER_COLUMNS))
    return Report(
        facts=Dataset("events", ["event_type", "props"], ["value"], events),
        dimension=Dataset("customer", ["c_name", "c_mktsegment"], ["c_acctbal"], customer),
        on=("user_id", "c_custkey"),
        fact_keys=["event_type"],
        dimension_keys=["c_mktsegment", "c_nationkey"],
        fact_measures={"avg_value": "value"},
        dimension_measures={"avg_acctbal": "c_acctbal"},
        key_type="string",
        options={"exact_scale": 2},
    )


# --- streams --------------------------------------------------------------------------------------


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in even parts, one per core for each of a few micro-batches, whatever files they came from."""
    return rows.repartition(MICRO_BATCHES * rows.sparkSession.sparkContext.defaultParallelism)


def _message_stream(spark: SparkSession, messages: DataFrame, folder: str) -> DataFrame:
    """Messages published as a folder, a file per part, and read back as a stream of micro-batches with a file per core."""
    write_messages(messages, f"{folder}/messages")
    return read_message_folder(spark, f"{folder}/messages", spark.sparkContext.defaultParallelism)


def _state_partitions(spark: SparkSession) -> int:
    """One per core, or as many as the session has if these are fewer: the queries' groups are few, and each partition costs a
    commit in every micro-batch and a file in every sink."""
    return min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _run_event_stream(spark: SparkSession, sf_dir: str, folder: str, messages: DataFrame) -> None:
    averages = average_messages(
        _message_stream(spark, messages, folder),
        string_schema(_table(spark, sf_dir, "events").columns),
        valid_dimension(_table(spark, sf_dir, "customer"), "c_custkey", ["c_acctbal"]),
        on=("user_id", "c_custkey"),
        fact_keys=["event_type"],
        dimension_keys=["c_mktsegment", "c_nationkey"],
        fact_measures={"avg_value": "value"},
        dimension_measures={"avg_acctbal": "c_acctbal"},
        exact_scale=2,
    )
    sinks = [message_folder_sink(f"{folder}/topic", "event_type"), parquet_sink(f"{folder}/table")]
    start_updates(
        averages, sinks, f"{folder}/checkpoint", available_now=True, partitions=_state_partitions(spark)
    ).awaitTermination()


def stream_enrich_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table the stream wrote, newest row per group."""
    folder = working_folder(spark, "stream")
    _run_event_stream(spark, sf_dir, folder, encode(_dealt(_table(spark, sf_dir, "events")), "user_id"))
    return latest_per_key(read_parquet(spark, f"{folder}/table"), KEYS).drop("timestamp", "batch_id")


def stream_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over messages of which some hold no JSON, some nothing, and some a measure that is no number."""
    folder = working_folder(spark, "stream")
    events = _table(spark, sf_dir, "events")
    worded = events.withColumn("value", F.expr("CASE WHEN event_id % 7 = 0 THEN 'abc' ELSE string(value) END"))
    messages = encode(worded.filter("event_id % 11 > 0 AND event_id % 13 > 0"), "user_id")
    for part, value in (("event_id % 11 = 0", "{'user_id"), ("event_id % 13 = 0", None)):
        bad = encode(events.filter(part), "user_id").withColumn("value", F.lit(value).cast("string"))
        messages = messages.unionByName(bad)
    _run_event_stream(spark, sf_dir, folder, _dealt(messages))
    return latest_per_key(read_parquet(spark, f"{folder}/table"), KEYS).drop("timestamp", "batch_id")


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages the same stream wrote to its second sink, newest per group."""
    folder = working_folder(spark, "stream")
    _run_event_stream(spark, sf_dir, folder, encode(_dealt(_table(spark, sf_dir, "events")), "user_id"))
    messages = read_parquet(spark, f"{folder}/topic")
    schema = string_schema([*KEYS, "avg_value", "avg_acctbal"])
    fields = messages.select(
        "batch_id", F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select("batch_id", "data.*")
    newest = latest_per_key(
        cast_columns(fields, {"c_nationkey": "int", "avg_value": "double", "avg_acctbal": "double"}), KEYS
    )
    return newest.drop("batch_id")


def stream_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which a third of the messages has one key: found in the first micro-batch and spread from the second on, over
    customers held on the executors; every row has the time of the run."""
    folder = working_folder(spark, "stream")
    crowded = F.expr("CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END")
    events = _table(spark, sf_dir, "events").withColumn("user_id", crowded)
    messages = _message_stream(spark, encode(_dealt(events), "user_id"), folder)

    def customers() -> DataFrame:
        wanted = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
        return valid_dimension(wanted, "c_custkey", ["c_acctbal"])

    def version() -> tuple[int, str]:
        return files_version(spark, f"{sf_dir}/customer.parquet")

    held = HeldDimension(customers, "c_custkey", spark.sparkContext.defaultParallelism, version)
    sketch = KeySketch("user_id", share=0.2)

    def averages(generation: Generation) -> DataFrame:
        return average_messages(
            messages,
            string_schema(events.columns),
            held.generation(*generation),
            on=("user_id", "c_custkey"),
            fact_keys=["event_type"],
            dimension_keys=["c_mktsegment", "c_nationkey"],
            fact_measures={"avg_value": "value"},
            dimension_measures={"avg_acctbal": "c_acctbal"},
            exact_scale=2,
            run_ts=F.lit(RUN_TIME).cast("timestamp_ntz"),
            hot=generation.hot,
            watch=sketch.watched,
        )

    sinks = {"table": parquet_sink(f"{folder}/table")}
    FollowingQuery(
        spark, averages, sinks, f"{folder}/checkpoint", version, sketch, True, ledger=True, partitions=_state_partitions(spark)
    ).awaitTermination()
    held.release()
    return latest_per_key(read_parquet(spark, f"{folder}/table"), KEYS).drop("batch_id")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows of the history a stream wrote, from a snapshot of its first batches and those behind it."""
    folder = working_folder(spark, "stream")
    _run_event_stream(spark, sf_dir, folder, encode(_dealt(_table(spark, sf_dir, "events")), "user_id"))
    for through in (0, 2):
        compact_history(spark, f"{folder}/table", f"{folder}/snapshot", KEYS, buckets=8, through=through)
    return latest_state(spark, f"{folder}/table", f"{folder}/snapshot", KEYS).drop("timestamp", "batch_id")


def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "tail")
    messages = _message_stream(spark, encode(_dealt(_table(spark, sf_dir, "customer")), "c_custkey"), folder)
    tail_to_files(messages, f"{folder}/out", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return read_parquet(spark, f"{folder}/out")


# --- driver contract ------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return gold_avg_stats(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    found = {**table_queries(), **(llm_queries.queries() if llm_queries else {})}
    return {name: _with_package(query) for name, query in found.items()}


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query``, its Python workers told where this package lies, wherever the session was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        here, env = os.path.dirname(os.path.abspath(__file__)), spark.sparkContext.environment
        paths = env.get("PYTHONPATH", "").split(os.pathsep)
        if here not in paths:
            env["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of this library without the subpackage for training data."""
    return {
        "gold_avg_stats": gold_avg_stats,
        "gold_avg_reduced": gold_avg_reduced,
        "gold_avg_lineitem": gold_avg_lineitem,
        "gold_avg_repeated": gold_avg_repeated,
        "gold_avg_double": gold_avg_double,
        "avg_null_group": avg_null_group,
        "inner_join": inner_join,
        "project_alias": project_alias,
        "parquet_scan": parquet_scan,
        "balanced_scan": balanced_scan,
        "cast_columns": cast_type_columns,
        "clean_text": clean_text,
        "dedupe_rows": dedupe_rows,
        "clean_null_token": clean_null_token,
        "clean_keep_null": clean_keep_null,
        "udf_map_columns": udf_map_columns,
        "numeric_filter": numeric_filter,
        "valid_dimension": valid_dimension_table,
        "silver_clean": silver_clean,
        "preview_limit": preview_limit,
        "json_envelope": json_envelope,
        "json_decode": json_decode,
        "publish_folder": publish_folder,
        "publish_changes": publish_second_time,
        "csv_to_bronze": csv_to_bronze,
        "medallion_avg": medallion_avg,
        "medallion_dirty": medallion_dirty,
        "medallion_versions": medallion_versions,
        "stream_enrich_agg": stream_enrich_agg,
        "stream_bad_messages": stream_bad_messages,
        "stream_fan_out": stream_fan_out,
        "stream_followed": stream_followed,
        "stream_compacted": stream_compacted,
        "stream_passthrough": stream_passthrough,
    }


def _clean_sql(column: str) -> str:
    return f"""regexp_replace(coalesce({column}, 'None'), '[^a-zA-Z0-9,.\\\\"'']', '', 'g')"""


def _average_sql(column: str) -> str:
    """Average of a column with two decimals, rounded half away from zero in integer arithmetic."""
    total, n = f"sum(cast(round({column} * 100) as bigint))", f"count({column})"
    return f"cast(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) as double) / 100"


_STATUS_SQL = "case when o_orderstatus <> 'P' then o_orderstatus end"
_SIZE_SQL = """case when p_size % 7 = 0 then 'na' when p_size % 7 = 1 then p_size || '-10'
    when p_size % 7 = 2 then null else cast(p_size as varchar) end"""
_CUSTOMER_JSON_SQL = """cast(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
    'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) as varchar)"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, for every query that SQL can express."""
    return {**table_sql(), **(llm_queries.oracle_sql() if llm_queries else {})}


def table_sql() -> dict[str, str]:
    """SQL for every one of ``table_queries``."""
    event_averages = f"""
        select event_type, c_mktsegment, c_nationkey,
            {_average_sql("value")} as avg_value, {_average_sql("c_acctbal")} as avg_acctbal
        from events join customer on user_id = c_custkey group by all"""
    cleaned_averages = f"""
        select {_clean_sql("event_type")} as event_type, {_clean_sql("c_mktsegment")} as c_mktsegment, c_nationkey,
            {_average_sql("value")} as avg_value, {_average_sql("c_acctbal")} as avg_acctbal
        from events join customer on user_id = c_custkey group by all"""
    return {
        "gold_avg_stats": event_averages,
        "gold_avg_reduced": event_averages,
        "gold_avg_lineitem": f"""
            select l_returnflag, l_linestatus, p_type, p_brand, {_average_sql("l_extendedprice")} as avg_price,
                {_average_sql("l_quantity")} as avg_quantity, {_average_sql("p_retailprice")} as avg_retail
            from lineitem join part on l_partkey = p_partkey group by all""",
        "gold_avg_repeated": f"""
            select event_type, o_orderpriority, {_average_sql("value")} as avg_value,
                {_average_sql("o_totalprice")} as avg_total
            from events join orders on user_id = o_custkey group by all""",
        "gold_avg_double": f"""
            select l_returnflag, p_type, {_average_sql("p_size")} as avg_size, timestamp '{RUN_TIME}' as "timestamp"
            from lineitem join part on l_partkey = p_partkey group by all""",
        "avg_null_group": f"""
            select {_STATUS_SQL} as status, o_orderpriority, {_average_sql("o_totalprice")} as avg_total
            from orders group by all""",
        "inner_join": """
            select event_id, user_id, event_type, value, c_mktsegment, c_nationkey, c_acctbal
            from events join customer on user_id = c_custkey""",
        "project_alias": """
            select o.o_orderkey as order_id, o.o_totalprice as total, c.c_name as buyer, c.c_mktsegment as segment
            from orders o join customer c on o.o_custkey = c.c_custkey""",
        "parquet_scan": "select * from events",
        "balanced_scan": "select event_id, user_id, value from events",
        "cast_columns": """
            select cast(event_id as varchar) as event_id, cast(user_id as double) as user_id, event_type, value
            from events""",
        "clean_text": f"""
            select doc_id, {_clean_sql("text")} as text, lang, {_clean_sql("source")} as source, n_chars
            from documents""",
        "dedupe_rows": f"""
            select distinct {_clean_sql("text")} as text, lang, {_clean_sql("source")} as source from documents""",
        "clean_null_token": f"""
            select o_orderkey, {_clean_sql(_STATUS_SQL)} as status, {_clean_sql("o_orderpriority")} as priority
            from orders""",
        "clean_keep_null": f"select o_orderkey, {_STATUS_SQL} as status from orders",
        "udf_map_columns": f"select o_orderkey, {_clean_sql('o_orderpriority')} as o_orderpriority from orders",
        "numeric_filter": f"""
            select p_partkey, try_cast(size_text as double) as size_text, p_retailprice
            from (select *, {_SIZE_SQL} as size_text from part)
            where try_cast(size_text as double) is not null and p_retailprice is not null""",
        "valid_dimension": f"""
            select cast(p_partkey as varchar) as p_partkey, p_type, try_cast(size_text as double) as size_text,
                p_retailprice
            from (select *, {_SIZE_SQL} as size_text from part)
            where try_cast(size_text as double) is not null and p_retailprice is not null""",
        "silver_clean": f"""
            select distinct {_clean_sql("p_name")} as p_name, {_clean_sql("p_type")} as p_type, size_text
            from (select *, {_SIZE_SQL} as size_text from part) where try_cast(size_text as double) is not null""",
        "preview_limit": f"""
            select distinct p_partkey, {_clean_sql("p_name")} as p_name, {_clean_sql("p_type")} as p_type, size_text
            from (select *, {_SIZE_SQL} as size_text from part) where try_cast(size_text as double) is not null
            order by p_partkey limit 10""",
        "json_envelope": f"select cast(c_custkey as varchar) as key, {_CUSTOMER_JSON_SQL} as value from customer",
        "publish_folder": f"select cast(c_custkey as varchar) as key, {_CUSTOMER_JSON_SQL} as value from customer",
        "publish_changes": f"""
            select cast(c_custkey as varchar) as key,
                case when c_custkey % 17 > 0 then {_CUSTOMER_JSON_SQL.replace("'c_name': c_name", "'c_name': c_name || '!'")} end as value
            from customer where c_custkey % 10 = 0 or c_custkey % 17 = 0""",
        "json_decode": """
            select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') as ts,
                cast(user_id as varchar) as user_id, event_type, cast(value as varchar) as value, props
            from events""",
        "csv_to_bronze": "select * from customer",
        "medallion_avg": cleaned_averages,
        "medallion_dirty": f"""
            {cleaned_averages.replace("group by all", "")}
            where event_id % 10 <> 0 and c_custkey % 10 <> 0 group by all""",
        "medallion_versions": cleaned_averages,
        "stream_enrich_agg": event_averages,
        "stream_bad_messages": f"""
            select event_type, c_mktsegment, c_nationkey,
                {_average_sql("case when event_id % 7 <> 0 then value end")} as avg_value,
                {_average_sql("c_acctbal")} as avg_acctbal
            from events join customer on user_id = c_custkey
            where event_id % 11 <> 0 and event_id % 13 <> 0 group by all""",
        "stream_fan_out": event_averages,
        "stream_followed": f"""
            select *, timestamp '{RUN_TIME}' as "timestamp" from ({event_averages.replace(
                "from events", "from (select * replace (case when event_id % 3 = 0 then 1 else user_id end as user_id) from events)"
            )})""",
        "stream_compacted": event_averages,
        "stream_passthrough": f"select {_CUSTOMER_JSON_SQL} as value from customer",
    }
