"""Row quality: mandatory fields, anomalies, duplicates, dates, dead letters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwater.schema import MANDATORY, NON_NEGATIVE, RELIABILITY_TARGET


def mandatory_present(columns: list[str] = MANDATORY) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def amounts_plausible(columns: list[str] = NON_NEGATIVE) -> Column:
    """Null or at least zero. NaN sorts above every number in Spark, so it passes."""
    return reduce(lambda a, b: a & b, [F.col(c).isNull() | (F.col(c) >= 0) for c in columns])


def filter_mandatory(df: DataFrame) -> DataFrame:
    return df.filter(mandatory_present())


def filter_anomalies(df: DataFrame) -> DataFrame:
    return df.filter(amounts_plausible())


def filter_quality(df: DataFrame) -> DataFrame:
    """The rows that have no reason to be rejected; what reading could not parse goes too."""
    return df.filter(is_valid(df))


def is_valid(df: DataFrame) -> Column:
    """The one rule that cleaning, statistics and dead letters share."""
    return F.size(reject_reasons(df)) == 0


def _latest_match(df: DataFrame, key: str, ts: str, null_safe: bool) -> tuple[DataFrame, Column]:
    latest = df.groupBy(F.col(key).alias("_latest_key")).agg(F.max(ts).alias("_latest_ts"))
    pairs = [(F.col(key), F.col("_latest_key")), (F.col(ts), F.col("_latest_ts"))]
    match = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return latest, match[0] & match[1]


def dedup_latest(
    df: DataFrame,
    key: str = "event_id",
    ts: str = "timestamp",
    ties: str = "keep",
    tie_break: list[str] | None = None,
    null_safe: bool = True,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Keep each key's rows with the latest timestamp.

    ``ties="keep"``: every row at the latest instant stays. The latest instant
    per key is a map-side combined aggregate over two narrow columns, and the
    rows meet it in a semi join on (key, instant). Neither side ever gathers a
    key into one task: superseded copies of a hot key hash apart by instant,
    and copies at one instant are split by the adaptive skew join, which a rank
    window could not do.

    ``ties="one"``: exactly one row, chosen by ``tie_break`` (descending).
    ``row_number() = 1`` trims to one row per key and map task before the
    shuffle, so a hot key stays small here too.

    ``rows`` may carry the same rows with an observation attached, so that the
    narrow aggregate does not count them twice.
    """
    if ties == "one":
        order = [F.col(c).desc() for c in [ts, *(tie_break or [])]]
        number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        return (df if rows is None else rows).withColumn("_n", number).filter("_n = 1").drop("_n")
    if ties != "keep":
        raise ValueError(f"ties must be 'keep' or 'one', not {ties!r}")
    latest, match = _latest_match(df, key, ts, null_safe)
    return (df if rows is None else rows).join(latest, match, "left_semi")


def superseded(df: DataFrame, key: str = "event_id", ts: str = "timestamp", null_safe: bool = True) -> DataFrame:
    """The rows :func:`dedup_latest` drops."""
    latest, match = _latest_match(df, key, ts, null_safe)
    return df.join(latest, match, "left_anti")


def derived_date(ts: str = "timestamp") -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def add_partition_date(df: DataFrame, mode: str = "all_or_nothing", check: DataFrame | None = None) -> DataFrame:
    """Partition column ``date`` from the timestamp.

    ``all_or_nothing``: one null ``date`` anywhere and every row is derived
    anew. The test is a scalar subquery that stops at the first null, not a
    job of its own. ``fill``: only null dates are derived; works on streams.
    """
    if "date" not in df.columns:
        return df.withColumn("date", derived_date())
    if mode == "fill" or df.isStreaming:
        return df.withColumn("date", F.coalesce(F.col("date"), derived_date()))
    if mode != "all_or_nothing":
        raise ValueError(f"mode must be 'all_or_nothing' or 'fill', not {mode!r}")
    source = check if check is not None else df
    missing = source.filter(F.col("date").isNull()).select("date").limit(1).agg(F.count(F.lit(1))).scalar()
    return df.withColumn("date", F.when(missing > 0, derived_date()).otherwise(F.col("date")))


def clean_events(df: DataFrame, ties: str = "keep", date_mode: str = "all_or_nothing") -> DataFrame:
    """Quality filters, then deduplication, then the partition date.

    With ``ties="keep"`` and an all-or-nothing date the source is read twice:
    one aggregate gives each key's latest instant and whether a row there lacks a date, and the
    rows meet it in the semi join. The deduplication is not repeated for the date test.
    """
    valid = filter_quality(df)
    if ties != "keep" or date_mode != "all_or_nothing" or "date" not in df.columns or df.isStreaming:
        return add_partition_date(dedup_latest(valid, ties=ties, null_safe=False), mode=date_mode)
    # Instants are of fixed width, so both maxima are hashed and combined before the shuffle; a row at the
    # latest instant lacks a date where the latest instant without one is the same.
    per_key = valid.groupBy(F.col("event_id").alias("_latest_key")).agg(
        F.max("timestamp").alias("_latest"), F.max(F.when(F.col("date").isNull(), F.col("timestamp"))).alias("_undated")
    )
    kept = valid.join(per_key, (F.col("event_id") == F.col("_latest_key")) & (F.col("timestamp") == F.col("_latest")), "left_semi")
    missing = per_key.agg(F.coalesce(F.bool_or(F.col("_undated") == F.col("_latest")), F.lit(False))).scalar()
    return kept.withColumn("date", F.when(missing, derived_date()).otherwise(F.col("date")))


def ingestion_stats(df: DataFrame, source: str | None = None) -> DataFrame:
    """One row: records read, valid, rejected and reliability (0.0 when empty).

    Two map-side combined aggregates replace the counts over the raw and the
    cleaned frame: per key and instant, then per key the valid rows at its
    latest valid instant.
    """
    ok = is_valid(df)
    per_instant = df.groupBy("event_id", "timestamp").agg(
        F.count(F.lit(1)).alias("_read"), F.count_if(ok).alias("_ok")
    )
    per_key = per_instant.groupBy("event_id").agg(
        F.sum("_read").alias("_read"),
        F.max_by("_ok", F.when(F.col("_ok") > 0, F.col("timestamp"))).alias("_valid"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("_read"), F.lit(0)).cast("long").alias("records_read"),
        F.coalesce(F.sum("_valid"), F.lit(0)).cast("long").alias("records_valid"),
    )
    return totals.select(
        F.lit(source).cast("string").alias("source"),
        "records_read",
        "records_valid",
        (F.col("records_read") - F.col("records_valid")).alias("records_rejected"),
        F.coalesce(F.try_divide(F.col("records_valid"), F.col("records_read")), F.lit(0.0)).alias("reliability"),
    )


def reliability_alert(stats: DataFrame, target: float = RELIABILITY_TARGET) -> DataFrame:
    return stats.withColumn("target", F.lit(target)).withColumn("below_target", F.col("reliability") < target)


def reject_reasons(df: DataFrame) -> Column:
    """Array of the row-level reasons a record is rejected for; empty if none."""
    tests = [(F.col(c).isNull(), f"{c}_missing") for c in MANDATORY]
    tests += [(F.col(c) < 0, f"{c}_negative") for c in NON_NEGATIVE]
    if "_corrupt" in df.columns:
        tests.append((F.col("_corrupt").isNotNull(), "corrupt_record"))
    if "_cast_errors" in df.columns:
        tests.append((F.size("_cast_errors") > 0, "type_mismatch"))
    return F.array_compact(F.array(*[F.when(test, F.lit(reason)) for test, reason in tests]))


def dead_letter(df: DataFrame) -> DataFrame:
    """Rejected rows with ``reasons``; superseded duplicates of valid rows too.

    The source is read twice: the latest valid instant per key is a combined aggregate that the tagged rows meet
    in one left join, whose hot keys, and the rows without a key, the adaptive skew join splits.
    """
    tagged = df.withColumn("reasons", reject_reasons(df))
    latest = filter_quality(df).groupBy(F.col("event_id").alias("_latest_key")).agg(F.max("timestamp").alias("_latest_ts"))
    met = tagged.join(latest, F.col("event_id") == F.col("_latest_key"), "left").drop("_latest_key")
    invalid = F.size("reasons") > 0
    late = F.col("timestamp") < F.col("_latest_ts")
    reasons = F.when(invalid, F.col("reasons")).otherwise(F.array(F.lit("superseded_duplicate")))
    return met.filter(invalid | late).withColumn("reasons", reasons).drop("_latest_ts")
