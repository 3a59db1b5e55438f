"""Batch sources under the fixed event schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightwater.operators.quality import add_partition_date, clean_events, dedup_latest, filter_quality
from brightwater.schema import EVENT_SCHEMA


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).option("mergeSchema", "true").parquet(path)


def _with_corrupt() -> T.StructType:
    return T.StructType([*EVENT_SCHEMA.fields, T.StructField("_corrupt", T.StringType(), True)])


def read_json(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Newline-delimited JSON; ``keep_corrupt`` adds the raw text of bad lines."""
    reader = spark.read.option("multiLine", "false")
    if not keep_corrupt:
        return reader.schema(EVENT_SCHEMA).json(path)
    return reader.schema(_with_corrupt()).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    reader = spark.read.option("header", "true")
    if not keep_corrupt:
        return reader.schema(EVENT_SCHEMA).csv(path)
    return reader.schema(_with_corrupt()).option("columnNameOfCorruptRecord", "_corrupt").csv(path)


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None, fmt: str = "delta") -> DataFrame:
    """A catalog table by name, or a path in a table format whose jar the session has."""
    frame = spark.read.table(name) if name else spark.read.format(fmt).load(path)
    return enforce_schema(frame)


def enforce_schema(df: DataFrame, keep_errors: bool = False) -> DataFrame:
    """Project any frame onto the event schema.

    Missing columns become null and failed casts become null. ``keep_errors``
    adds ``_cast_errors``, the names of the columns whose cast failed, which the
    dead letter reports as a type mismatch.
    """
    columns: list[Column] = []
    errors: list[Column] = []
    types = dict(df.dtypes)
    for field in EVENT_SCHEMA.fields:
        kind = field.dataType.simpleString()
        if field.name not in types:
            columns.append(F.lit(None).cast(kind).alias(field.name))
            continue
        value = F.col(field.name).try_cast(kind)
        columns.append(value.alias(field.name))
        if types[field.name] != kind:
            failed = F.col(field.name).isNotNull() & value.isNull()
            errors.append(F.when(failed, F.lit(field.name)))
    if keep_errors:
        found = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
        columns.append(found.alias("_cast_errors"))
    return df.select(*columns)


def ingest(raw: DataFrame, ties: str = "keep", date_mode: str = "all_or_nothing") -> DataFrame:
    """Quality filters, deduplication, partition date."""
    return clean_events(raw, ties=ties, date_mode=date_mode)


def ingest_observed(
    raw: DataFrame, name: str, ties: str = "keep", date_mode: str = "all_or_nothing"
) -> tuple[DataFrame, Observation, Observation]:
    """:func:`ingest` with the record counts taken while the rows are written.

    The observations fill in when the returned frame is first executed, which
    saves the two counting jobs. Use :func:`stats_from_observations` after it.
    """
    seen, kept = Observation(f"{name}_read"), Observation(f"{name}_valid")
    counted = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    # Only the rows' side of the semi join carries the observation.
    clean = dedup_latest(filter_quality(raw), ties=ties, null_safe=False, rows=filter_quality(counted))
    unobserved = dedup_latest(filter_quality(raw), ties=ties, null_safe=False)
    clean = add_partition_date(clean, mode=date_mode, check=unobserved)
    return clean.observe(kept, F.count(F.lit(1)).alias("n")), seen, kept


def stats_from_observations(source: str, seen: Observation, kept: Observation) -> dict[str, object]:
    read, valid = seen.get["n"], kept.get["n"]
    return {
        "source": source,
        "records_read": read,
        "records_valid": valid,
        "records_rejected": read - valid,
        "reliability": valid / read if read else 0.0,
    }


def ingest_parquet(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return ingest(read_parquet(spark, path), **options)


def ingest_json(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return ingest(read_json(spark, path), **options)


def ingest_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return ingest(read_csv(spark, path), **options)


def ingest_table(spark: SparkSession, name: str | None = None, path: str | None = None, **options: str) -> DataFrame:
    return ingest(read_table(spark, name, path), **options)
