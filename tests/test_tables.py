from __future__ import annotations

import glob

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brightwater.operators import tables


def people(spark, rows, schema="id int, name string"):
    return spark.createDataFrame(rows, schema)


def contents(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_updates_inserts_and_adds_columns(spark):
    target = people(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = people(spark, [(2, "B", 5), (3, "C", 6), (None, "N", 7)], "id int, name string, extra int")
    out = tables.upsert(target, source, ["id"])
    assert contents(out) == sorted(
        [(1, "a", None), (2, "B", 5), (3, "C", 6), (None, "n", None), (None, "N", 7)], key=str
    )


def test_upsert_is_idempotent(spark):
    target, source = people(spark, [(1, "a")]), people(spark, [(1, "x"), (2, "y")])
    once = tables.upsert(target, source, ["id"])
    assert contents(tables.upsert(once, source, ["id"])) == contents(once)


def test_upsert_rejects_two_source_rows_for_one_target_row(spark):
    target, source = people(spark, [(1, "a")]), people(spark, [(1, "x"), (1, "y")])
    with pytest.raises(PySparkException, match="several source rows"):
        tables.upsert(target, source, ["id"]).collect()
    unmatched = people(spark, [(9, "x"), (9, "y")])
    assert tables.upsert(target, unmatched, ["id"]).count() == 3


def test_upsert_needs_keys_and_all_target_columns(spark):
    target = people(spark, [(1, "a")])
    with pytest.raises(ValueError, match="merge keys"):
        tables.upsert(target, target, [])
    with pytest.raises(ValueError, match="lacks"):
        tables.upsert(target, target.select("id"), ["id"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.dictionaries(st.integers(0, 9), st.text("xyz", max_size=2), max_size=8),
    source=st.dictionaries(st.integers(0, 9), st.text("xyz", max_size=2), max_size=8),
)
def test_upsert_behaves_like_a_dictionary(spark, target, source):
    out = tables.upsert(people(spark, list(target.items())), people(spark, list(source.items())), ["id"])
    assert dict(contents(out)) == {**target, **source}


def test_first_upsert_creates_the_table(spark, tmp_path):
    out = str(tmp_path / "new")
    tables.upsert_table(spark, str(tmp_path / "absent"), people(spark, [(1, "a")]), ["id"], out)
    assert contents(tables.read(spark, out)) == [(1, "a")]


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 3, "c")], "part string, id int, name string")
    tables.overwrite(rows, path, ["part"])
    untouched = glob.glob(f"{path}/part=y/*.parquet")
    source = spark.createDataFrame([("x", 2, "B"), ("z", 4, "d")], "part string, id int, name string")
    tables.upsert_partitions(spark, path, source, ["part", "id"], ["part"])
    assert glob.glob(f"{path}/part=y/*.parquet") == untouched
    assert contents(tables.read(spark, path).select("part", "id", "name")) == [
        ("x", 1, "a"),
        ("x", 2, "B"),
        ("y", 3, "c"),
        ("z", 4, "d"),
    ]
    with pytest.raises(ValueError):
        tables.upsert_partitions(spark, path, source, ["id"], ["part"])


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(None, 2), (None, 3), ("01", 1), ("02", 5)], "part string, id int")
    tables.overwrite(rows, path, ["part"])
    source = spark.createDataFrame([(None, 9), ("01", 1)], "part string, id int")
    tables.upsert_partitions(spark, path, source, ["part", "id"], ["part"], schema=rows.schema)
    out = tables.read(spark, path, schema=rows.schema).select("part", "id")
    assert contents(out) == sorted([(None, 2), (None, 3), (None, 9), ("01", 1), ("02", 5)], key=str)


def test_partition_values_keep_their_types_with_a_schema(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("2024-01-02", "01", 1)], "date string, region string, id int")
    tables.overwrite(rows, path, ["date", "region"])
    assert contents(tables.read(spark, path, schema=rows.schema).select(*rows.columns)) == [("2024-01-02", "01", 1)]


def test_compaction_keeps_partitions(spark, tmp_path):
    path, out = str(tmp_path / "many"), str(tmp_path / "few")
    rows = spark.range(900).select("id", F.concat(F.lit("0"), F.col("id") % 3).alias("part"))
    tables.overwrite(rows.repartition(9), path, ["part"])
    tables.compact_table(spark, path, out, ["id"], partition_by=["part"], schema=rows.schema)
    assert len(glob.glob(f"{out}/part=0*/*.parquet")) == 3
    assert contents(tables.read(spark, out, schema=rows.schema).select("id", "part")) == contents(rows)


def test_overwrite_replaces_every_partition(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.overwrite(people(spark, [(1, "a"), (2, "b")]), path, ["name"])
    tables.overwrite(people(spark, [(3, "c")]), path, ["name"])
    assert contents(tables.read(spark, path)) == [(3, "c")]


def test_append_evolves_the_schema(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.append(people(spark, [(1, "a")]), path)
    tables.append(people(spark, [(2, "b", 3)], "id int, name string, extra int"), path)
    assert contents(tables.read(spark, path)) == [(1, "a", None), (2, "b", 3)]


def test_compaction_changes_layout_only(spark, tmp_path):
    path, out = str(tmp_path / "many"), str(tmp_path / "few")
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    rows.repartition(40).write.parquet(path)
    size = tables.estimated_bytes(tables.read(spark, path))
    tables.compact_table(spark, path, out, ["k"], target_file_bytes=size // 4)
    before, after = tables.read(spark, path), tables.read(spark, out)
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0
    files = glob.glob(f"{out}/*.parquet")
    assert 3 <= len(files) <= 6
    # The hot value is cut over files instead of filling one.
    hot = after.filter("k = 7").groupBy(F.input_file_name()).count().collect()
    assert len(hot) >= 2


def test_partition_pruning_on_read_back(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.overwrite(people(spark, [(1, "a"), (2, "b")]), path, ["name"])
    plan = tables.read(spark, path).filter("name = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(name" in plan


def test_feature_export_checks_columns(spark):
    with pytest.raises(ValueError, match="missing"):
        tables.feature_export(people(spark, [(1, "a")]), ["score"])


def test_z_order_lets_a_predicate_on_either_column_skip_files(spark, tmp_path):
    path, linear, z = (str(tmp_path / n) for n in ("many", "linear", "z"))
    rows = spark.range(40_000).select("id", (F.rand(1) * 1000).alias("x"), F.concat(F.lit("k"), (F.rand(2) * 9000 + 1000).cast("int")).alias("y"))
    rows = rows.withColumn("x", F.when(F.col("id") % 50 > 0, F.col("x")))
    rows.repartition(20).write.parquet(path)
    size = tables.estimated_bytes(tables.read(spark, path))
    tables.compact_table(spark, path, linear, ["x", "y"], target_file_bytes=size // 64)
    tables.compact_z_order(spark, path, z, ["x", "y"], target_file_bytes=size // 64)

    def touched(out, x, y):
        """Files whose range of values meets the predicate's, as statistics tell."""
        boxes = tables.read(spark, out).groupBy(F.input_file_name()).agg(*(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max)))).collect()
        return sum(b.lo_x is not None and b.lo_x <= x[1] and b.hi_x >= x[0] and b.lo_y <= y[1] and b.hi_y >= y[0] for b in boxes) / len(boxes)

    assert tables.read(spark, z).exceptAll(tables.read(spark, path)).count() == 0 and tables.read(spark, z).count() == 40_000
    assert touched(z, (100, 600), ("k2000", "k2500")) <= 0.6 * touched(linear, (100, 600), ("k2000", "k2500"))
    assert touched(z, (0, 1000), ("k2000", "k2500")) <= 0.5 * touched(linear, (0, 1000), ("k2000", "k2500"))
    with pytest.raises(ValueError, match="62 bits"):
        tables.compact_z_order(spark, path, str(tmp_path / "none"), [])
