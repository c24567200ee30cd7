"""What the learner writes, and what the executors keep for it."""

import random

import numpy as np
import pytest

from offerwise.plans import model
from offerwise.sources import staging

QUICK = {"maxDepth": 2, "minInstancesPerNode": 5, "featureFraction": 0.5, "stepSize": 0.3, "maxIter": 3}


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(4)
    data = [(i, i % 3, float(rng.random() < 0.4), *[rng.random() if rng.random() < 0.8 else None for _ in "abcd"]) for i in range(300)]
    table = spark.createDataFrame(data, "id int, fold int, redemption_status double, a double, b double, c double, d double")
    return staging.stage(model.feature_matrix(table, list("abcd"), ["fold"], ["a"]), "small-matrix")


def test_a_fold_writes_no_copy_of_the_matrix_and_keeps_nothing(spark, matrix, monkeypatch):
    written, stage = [], model.stage
    monkeypatch.setattr(model, "stage", lambda df, label: written.append(df.columns) or stage(df, label))
    kept = model.train_fold(matrix, 0, QUICK)
    assert kept.rounds and written and not [c for c in written if "features" in c]
    assert not matrix.storageLevel.useDisk and not matrix.storageLevel.useMemory
    margins = model.with_margins(matrix, kept, {0: "m0", len(kept.rounds): "m"}).collect()
    want = kept.forest().margins(np.array([r.features.toArray() for r in margins]))[:, -1]
    assert [r.m for r in margins] == pytest.approx(want.tolist()) and {r.m0 for r in margins} == {kept.first}


def test_folds_at_the_same_time_are_bounded_by_the_matrix(matrix, monkeypatch):
    size = model.matrix_bytes(matrix)
    assert size == 300 * 5 * 8
    for room, together, near in ((100 * size, model.TOGETHER, True), (3 * size, 3, True), (size - 1, 1, False)):
        monkeypatch.setattr(model, "KEPT_BYTES", room)
        with model.kept(matrix) as found:
            assert (found, matrix.storageLevel.useDisk) == (together, near)
    assert not matrix.storageLevel.useDisk


def test_matrix_query_stages_the_training_table_once(spark, monkeypatch):
    from types import SimpleNamespace

    from checks import queries

    data = [(i, i, 100, 1, 2, int(i < 8), i % 2, "b" if i else None) for i in range(10)]
    names = "id bigint, customer_id bigint, start_date_ord int, coupon_id bigint, campaign_id int, train_set int, redemption_status int, MCbrand string"
    table, labels = spark.createDataFrame(data, names), []

    def watched(df, label):
        labels.append(label)
        return staging.stage(df, label)

    monkeypatch.setattr(queries, "_training", lambda r: table)
    monkeypatch.setattr(queries, "stage", watched)
    monkeypatch.setattr(model, "stage", watched)
    item = spark.createDataFrame([("a",), ("b",)], "brand string")
    found = queries._matrices(SimpleNamespace(spark=spark, folder="small", item=item))
    assert labels.count("training-table") == 1
    assert found.train.count() == 8 and found.test.count() == 2 and found.flags == ["MCbrand"]
