from __future__ import annotations

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightwater import session
from brightwater.operators import forest, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 3)).round(1)
    made = spark.createDataFrame([(*map(float, r), float(r[0] * r[1] > 0)) for r in x], "a double, b double, c double, label double")
    return models.assemble(["a", "b", "c"]).transform(made).repartition(3).cache()


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(found.apply(i)) for i in range(found.size()) if "/shuffle_" in str(found.apply(i))}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(session.SHUFFLE_CLEANUP)
    table = session.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert table.count() == 7 and spark.conf.get(session.SHUFFLE_CLEANUP) == setting
    session.discard(table)
    assert not [f for f in table.inputFiles() if os.path.exists(f.removeprefix("file:"))]


@pytest.mark.parametrize("limit", [262_144, 200])
@pytest.mark.parametrize("task", ["classification", "regression"])
def test_trees_moved_a_few_at_a_time_are_the_same(spark, rows, monkeypatch, task, limit):
    monkeypatch.setattr(forest, "BRANCH_ROWS", limit)
    estimator, _ = models.model_for("random_forest", task, n_estimators=12)
    jobs, branches, said = [], forest._branches, forest.GrownForest._said
    monkeypatch.setattr(forest, "_branches", lambda *a: (jobs.append(len(a[3])), branches(*a))[1])
    monkeypatch.setattr(forest.GrownForest, "_said", lambda self, *a: (scored.append([t for g in a[1] for t in g]), said(self, *a))[1])
    grown, votes = [], []
    for most in (1 << 40, 60_000):
        monkeypatch.setattr(forest, "MOVED_BYTES", most)
        monkeypatch.setattr(forest, "SOURCE_ROWS", 1 << 20 if most > 60_000 else 300)
        jobs.clear()
        scored = []
        model = forest.grow(estimator, rows)
        grown.append(sorted((r.tree, r.node, bytes(r.feature), bytes(r.cut), bytes(r.value)) for r in model.branches.collect()))
        bins = rows.select(forest.binned(F.col("features"), model.cuts).alias("bins"))
        votes.append({bytes(r.bins): r.votes for r in model._votes(bins).collect()})
        assert [t for own in scored for t in own] == list(range(12)) and sum(jobs) == 12
        assert (len(jobs) == len(scored) == 1) if most > 60_000 else (len(jobs) > 2 and len(scored) > 2)
    assert grown[0] == grown[1] and votes[0].keys() == votes[1].keys()
    assert all(np.allclose(votes[0][b], votes[1][b]) for b in votes[0])


def test_trees_of_one_branch_add_their_votes_up_before_they_move(spark, rows):
    estimator, _ = models.model_for("random_forest", n_estimators=60)
    model = forest.grow(estimator, rows)
    bins = rows.select(forest.binned(F.col("features"), model.cuts).alias("bins"))
    moved = []
    said = forest.GrownForest._said

    class Watched(forest.GrownForest):
        def _said(self, *a):
            moved.append(said(self, *a))
            return moved[-1]

    watched = Watched(model.tops, model.shape, model.cuts, model.branches)
    votes = {bytes(r.bins): sum(r.votes) for r in watched._votes(bins).collect()}
    assert all(v == pytest.approx(60) for v in votes.values())
    assert sum(m.count() for m in moved) < 60
