"""Table writes: append, overwrite, upsert, compaction.

Tables are Parquet folders (any format the session has may be named). There is
no transaction log: one writer at a time, and an upsert or a compaction writes
a new folder because Spark cannot overwrite what it reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampNTZType, TimestampType

from brightwater.functions.spans import let
from brightwater.schema import require_columns
from brightwater.session import estimated_bytes

TARGET_FILE_BYTES = 256 * 1024 * 1024


def _write(df: DataFrame, path: str, mode: str, partition_by: list[str] | None, fmt: str, **options: str) -> None:
    if partition_by:
        # Rows of one partition value go to one file while they are few; the
        # adaptive rebalance splits a hot value over several tasks.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).option("mergeSchema", "true")
    for key, value in options.items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    _write(df, path, "append", partition_by, fmt)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Replace the whole table, whatever the session's partition overwrite mode."""
    _write(df, path, "overwrite", partition_by, fmt, partitionOverwriteMode="static")


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions the frame has rows for."""
    _write(df, path, "overwrite", partition_by, fmt, partitionOverwriteMode="dynamic")


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Read a table whose files may have gained columns over time.

    Partition values are text in folder names; without a schema Spark guesses
    their types ("01" becomes 1, a date string a date), so give one for tables whose partition
    columns look like numbers or dates. An empty string comes back as null either way.
    """
    reader = spark.read.format(fmt).option("mergeSchema", "true")
    return (reader.schema(schema) if schema else reader).load(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], check_duplicates: bool = True) -> DataFrame:
    """The target with source rows updated where the keys match and inserted where not.

    Keys compare with ``=``: a null key never matches and is inserted. New
    source columns are added (null on untouched rows); a target column the
    source lacks is an error. Several source rows for one target row fail the
    job when it runs.
    """
    if not keys:
        raise ValueError("merge keys required")
    lost = [c for c in target.columns if c not in source.columns]
    if lost:
        raise ValueError(f"source lacks target columns: {lost}")
    source_keys = source.select(*keys)
    untouched = target.join(source_keys, keys, "left_anti")
    merged = untouched.unionByName(source, allowMissingColumns=True)
    if not check_duplicates:
        return merged
    repeated = source_keys.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    # Aggregated again so that the check cannot move below the join, where it
    # would also see repeated keys that match nothing.
    clash = repeated.join(target.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max("_n").alias("_n"))
    # Yields no row: the first clash raises instead.
    guard = clash.filter(F.assert_true(F.col("_n") < 2, "several source rows match one target row").isNotNull())
    return merged.unionByName(guard.select(*keys), allowMissingColumns=True)


def upsert_table(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], out_path: str, fmt: str = "parquet", schema: StructType | None = None
) -> None:
    """Upsert into the table at ``path``, written to ``out_path``.

    The first write creates the table as it is, without partition columns.
    """
    if not keys:
        raise ValueError("merge keys required")
    if not exists(spark, path):
        source.write.format(fmt).save(out_path)
        return
    upsert(read(spark, path, fmt, schema), source, keys).write.format(fmt).mode("errorifexists").save(out_path)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_by: list[str],
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> None:
    """Upsert in place, rewriting only the partitions the source touches.

    Needs the partition columns among the keys, so that no matching row can sit
    in another partition, and a source that does not read the table itself. The null partition is one
    like any other: a source row in it keeps the rows that are there. Give the
    table's ``schema`` if its partition values look like numbers or dates.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be among the merge keys")
    target = read(spark, path, fmt, schema)
    touched = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(f"_touched_{c}") for c in partition_by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by]
    kept = target.join(touched, reduce(and_, same), "left_semi")
    overwrite_partitions(upsert(kept, source, keys), path, partition_by, fmt)


def compact_table(
    spark: SparkSession,
    path: str,
    out_path: str,
    sort_by: list[str] | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    schema: StructType | None = None,
) -> None:
    """Rewrite a table into few files, clustered by ``sort_by``. Contents stay the same.

    File count follows the stored size. ``partition_by`` names the table's
    partition columns: rows are ranged by them first, so a value's rows lie in few files and
    the layout stays. The row position breaks ties in the range bounds, so one
    hot value is cut over several files.
    """
    df = read(spark, path, fmt, schema)
    files = max(1, -(-estimated_bytes(df) // target_file_bytes))
    order = [*(partition_by or []), *(sort_by or [])]
    if order:
        placed = df.withColumn("_position", F.monotonically_increasing_id())
        df = placed.repartitionByRange(files, *order, "_position").sortWithinPartitions(*order).drop("_position")
    else:
        df = df.repartition(files)
    writer = df.write.format(fmt).mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(out_path)


def z_address(df: DataFrame, columns: list[str], bits: int = 8) -> Column:
    """Rank of each column among quantile bounds, the ranks' bits interleaved: rows near in all columns have near addresses.

    Bounds come from one pass of approximate quantiles over numbers, dates, instants or the first
    bytes of texts; a null ranks lowest. Runs a job; ``2 ** bits - 1`` bounds per column reach the driver.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError("between 1 column and 62 bits in all")
    values = [_ordered_value(df, c) for c in columns]
    cuts = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(*(F.percentile_approx(v, cuts).alias(f"b{i}") for i, v in enumerate(values))).first()
    address = F.lit(0).cast("long")
    for i, value in enumerate(values):
        bounds = sorted(set(found[f"b{i}"] or []))
        if bounds:
            address = address.bitwiseOR(let(_rank(value, bounds, bits), _spread(bits, len(columns), i)))
    return address


def _rank(value: Column, bounds: list[float], bits: int) -> Column:
    """How many of the sorted bounds the value reaches, by a binary search; 0 for null."""
    listed = F.array(*map(F.lit, bounds))

    def step(rank: Column, jump: Column) -> Column:
        reached = (rank + jump <= len(bounds)) & (value >= F.get(listed, rank + jump - 1))
        return rank + F.when(reached, jump).otherwise(0)

    return F.aggregate(F.array(*(F.lit(1 << bit) for bit in reversed(range(bits)))), F.lit(0), step)


def _spread(bits: int, ways: int, own: int) -> Callable[[Column], Column]:
    """Puts the bits of a rank ``ways`` apart, beginning at ``own``."""

    def spread(rank: Column) -> Column:
        out = F.lit(0).cast("long")
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * ways + own))
        return out

    return spread


def _ordered_value(df: DataFrame, column: str) -> Column:
    """A number that orders as the column does (texts by their first six bytes)."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, TimestampType | TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def compact_z_order(
    spark: SparkSession,
    path: str,
    out_path: str,
    columns: list[str],
    target_file_bytes: int = TARGET_FILE_BYTES,
    bits: int = 8,
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> None:
    """Rewrite a table into few files clustered by several columns at once. Contents stay the same.

    Rows are ranged by :func:`z_address`, so each file covers a small box of all ``columns`` and its
    statistics let a predicate on any of them skip files, where a sort on the first helps that one alone. The row
    position breaks ties, so rows with equal values are cut over several files.
    """
    df = read(spark, path, fmt, schema)
    files = max(1, -(-estimated_bytes(df) // target_file_bytes))
    placed = df.withColumns({"_z": z_address(df, columns, bits), "_position": F.monotonically_increasing_id()})
    ranged = placed.repartitionByRange(files, "_z", "_position").sortWithinPartitions("_z").drop("_z", "_position")
    ranged.write.format(fmt).mode("errorifexists").save(out_path)


def feature_export(features: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Model inputs as a DataFrame for the trainer; nothing is collected."""
    require_columns(features.columns, columns)
    return features.select(*(keep or []), *[F.col(c).cast("double").alias(c) for c in columns])
