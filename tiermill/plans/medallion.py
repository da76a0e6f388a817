"""Landing to bronze to silver to gold. Each stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tiermill.functions.text import KEPT_CHARACTERS, NULL_TOKEN
from tiermill.operators.averages import RunTime, enriched_averages
from tiermill.operators.columns import clean_columns, dedupe, keep_numeric
from tiermill.operators.joins import Columns
from tiermill.sinks.files import show_preview, write_parquet
from tiermill.sources.csv_types import land_csv
from tiermill.sources.files import read_csv, read_parquet
from tiermill.sources.layers import read_layer, replace_layer


@dataclass(frozen=True)
class Dataset:
    """One input of the pipeline: which columns are cleaned, and which must hold numbers.

    Without ``schema`` the types of the CSV file are inferred while it is landed, or with ``infer=False`` all columns are text.
    """

    name: str
    text_columns: Sequence[str] = ()
    numeric_columns: Sequence[str] = ()
    schema: T.StructType | str | None = None
    infer: bool = True


@dataclass(frozen=True)
class Report:
    """What gold computes from a fact and a dimension dataset; ``columns`` sets the order of the output."""

    facts: Dataset
    dimension: Dataset
    on: tuple[str, str]
    fact_keys: Columns
    dimension_keys: Columns
    fact_measures: Columns = ()
    dimension_measures: Columns = ()
    key_type: str | None = None
    columns: Sequence[str] = ()
    name: str = "avg_stats"
    options: Mapping[str, object] = field(default_factory=dict)


def refine(
    df: DataFrame,
    text_columns: Sequence[str],
    numeric_columns: Sequence[str] = (),
    keep: str = KEPT_CHARACTERS,
    null_token: str | None = NULL_TOKEN,
) -> DataFrame:
    """Clean text, then drop duplicates, then drop rows whose numbers do not parse.

    The number filter looks at columns that are not cleaned, so Spark runs it first, at the scan.
    """
    return keep_numeric(dedupe(clean_columns(df, text_columns, keep, null_token)), numeric_columns)


def summarise(facts: DataFrame, dimension: DataFrame, report: Report, run_ts: RunTime = None) -> DataFrame:
    """The report's averages over two refined tables."""
    averages = enriched_averages(
        facts,
        dimension,
        report.on,
        report.fact_keys,
        report.dimension_keys,
        report.fact_measures,
        report.dimension_measures,
        report.key_type,
        run_ts=run_ts,
        **report.options,
    )
    return averages.select(*report.columns) if report.columns else averages


def layer(lake: str, tier: str, name: str) -> str:
    """Path of a dataset in a tier of the lake."""
    return f"{lake}/{tier}/{name}.parquet"


def read_tier(spark: SparkSession, lake: str, tier: str, name: str, versioned: bool = False) -> DataFrame:
    """A dataset of a tier, written in place or in versions."""
    return (read_layer if versioned else read_parquet)(spark, layer(lake, tier, name))


def _writer(versioned: bool) -> Callable[[DataFrame, str], object]:
    return replace_layer if versioned else write_parquet


def to_bronze(
    spark: SparkSession, landing: str, lake: str, datasets: Sequence[Dataset], show: bool = False, versioned: bool = False
) -> None:
    """CSV files as they landed, to parquet. Each file is read once, also where its types are inferred.

    In all three stages ``versioned`` writes each layer as a new version that replaces the old one only when it is complete
    (``replace_layer``); by default it is overwritten in place, and gone if the job dies in between.
    """
    write = _writer(versioned)
    for data in datasets:
        source, out = f"{landing}/{data.name}.csv", layer(lake, "bronze", data.name)
        if data.schema is None and data.infer:
            land_csv(spark, source, out, write)
        else:
            write(read_csv(spark, source, data.schema, data.infer), out)
        if show:
            show_preview(read_tier(spark, lake, "bronze", data.name, versioned))


def to_silver(
    spark: SparkSession, lake: str, datasets: Sequence[Dataset], show: bool = False, versioned: bool = False
) -> None:
    """Bronze tables, refined."""
    for data in datasets:
        source = read_tier(spark, lake, "bronze", data.name, versioned)
        refined = refine(source, data.text_columns, data.numeric_columns)
        _writer(versioned)(refined, layer(lake, "silver", data.name))
        if show:
            show_preview(read_tier(spark, lake, "silver", data.name, versioned))


def to_gold(
    spark: SparkSession, lake: str, report: Report, run_ts: RunTime = None, show: bool = False, versioned: bool = False
) -> None:
    """The report over the silver tables."""
    facts, dimension = (read_tier(spark, lake, "silver", d.name, versioned) for d in (report.facts, report.dimension))
    _writer(versioned)(summarise(facts, dimension, report, run_ts), layer(lake, "gold", report.name))
    if show:
        show_preview(read_tier(spark, lake, "gold", report.name, versioned))


def run_medallion(
    spark: SparkSession,
    landing: str,
    lake: str,
    report: Report,
    run_ts: RunTime = None,
    show: bool = False,
    versioned: bool = False,
) -> DataFrame:
    """All three stages in order; returns the gold table as read back from the lake."""
    datasets = [report.dimension, report.facts]
    to_bronze(spark, landing, lake, datasets, show, versioned)
    to_silver(spark, lake, datasets, show, versioned)
    to_gold(spark, lake, report, run_ts, show, versioned)
    return read_tier(spark, lake, "gold", report.name, versioned)
