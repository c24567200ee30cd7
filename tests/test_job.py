"""The job from hand-made files to the submission."""

import csv
import datetime as dt
import random
import threading

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, IntegerType, StructType

from offerwise.functions.codes import CATEGORIES
from offerwise.plans import job, model
from offerwise.sources import tables
from offerwise.sources.manifest import Manifest, files_state
from offerwise.sources.staging import exists

QUICK = {"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 2, "featureFraction": 1.0}


def save(folder, name, header, rows):
    with open(folder / f"{name}.csv", "w", newline="") as out:
        csv.writer(out).writerows([header.split(","), *rows])


@pytest.fixture
def files(tmp_path):
    rng = random.Random(7)
    start = dt.date(2012, 8, 1)
    campaigns = []
    for i in range(6):
        first = start + dt.timedelta(days=40 * i)
        campaigns.append((i + 1, "XY"[i % 2], first.strftime("%d/%m/%y"), (first + dt.timedelta(days=50)).strftime("%d/%m/%y")))
    save(tmp_path, "campaign_data", "campaign_id,campaign_type,start_date,end_date", campaigns)
    items = [(i, rng.randint(1, 9), rng.choice(["Established", "Local"]), rng.choice(CATEGORIES)) for i in range(1, 41)]
    save(tmp_path, "item_data", "item_id,brand,brand_type,category", items)
    lines = []
    for _ in range(900):
        price = rng.randint(100, 9000) / 100
        coupon = rng.choice([0.0, 0.0, -round(price * 0.1, 2)])
        day = start + dt.timedelta(days=rng.randint(0, 260))
        lines.append((day, rng.randint(1, 20), rng.randint(1, 40), rng.randint(1, 4), price, -round(rng.random(), 2), coupon))
    save(tmp_path, "customer_transaction_data", "date,customer_id,item_id,quantity,selling_price,other_discount,coupon_discount", lines)
    save(tmp_path, "coupon_item_mapping", "coupon_id,item_id", [(1 + i % 8, i) for i in range(1, 41)])
    train = [(i, 1 + i % 4, 1 + i % 8, 1 + i % 20, "" if i == 5 else int(rng.random() < 0.4)) for i in range(120)]
    test = [(1000 + i, 5 + i % 2, 1 + i % 8, 1 + i % 20) for i in range(40)]
    save(tmp_path, "train", "id,campaign_id,coupon_id,customer_id,redemption_status", train)
    save(tmp_path, "test", "id,campaign_id,coupon_id,customer_id", test)
    return tmp_path


def test_files_become_a_submission(spark, files):
    out = str(files / "out")
    areas = job.run_job(spark, str(files), out, folds=2, params=QUICK)
    assert [r.fold for r in areas.orderBy("fold").collect()] == [0, 1]
    scores = tables.read_table(spark, f"{out}/submission", "submission").collect()
    assert sorted(r.id for r in scores) == list(range(1000, 1040)) and all(0 <= r.redemption_status <= 1 for r in scores)
    header = "feature string, split double, gain double"
    ranked = spark.read.schema(header).option("header", True).csv(f"{out}/importance").collect()
    assert sum(r.gain for r in ranked) == pytest.approx(100, abs=1e-3) or all(r.gain is None for r in ranked)
    assert len(ranked) > 200


def test_swapped_columns_stop_the_job(spark, files):
    text = (files / "coupon_item_mapping.csv").read_text().replace("coupon_id,item_id", "item_id,coupon_id")
    (files / "coupon_item_mapping.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)header|column"):
        job.table_from_files(spark, str(files))[0].count()


def test_a_named_run_goes_on_where_it_was_killed(spark, files, tmp_path, monkeypatch):
    """Killed in its second fold, it neither builds the table again nor trains the first fold again."""
    folder, run = str(files), f"again-{tmp_path.name}"
    train, trained = model.train_fold, []
    first_ended = threading.Event()

    def killed(matrix, fold, params):
        if fold == 1:
            # The other fold's model must be noted before the job dies.
            assert first_ended.wait(120)
            raise RuntimeError("lost")
        return train(matrix, fold, params)

    note = Manifest.note

    def noted(self, label, *args):
        note(self, label, *args)
        if label == "fold-0":
            first_ended.set()

    with monkeypatch.context() as m:
        m.setattr(model, "train_fold", killed)
        m.setattr(Manifest, "note", noted)
        with pytest.raises(RuntimeError, match="lost"):
            job.run_job(spark, folder, str(files / "out"), folds=2, params=QUICK, run=run)
    monkeypatch.setattr(model, "train_fold", lambda m, fold, p: trained.append(fold) or train(m, fold, p))
    monkeypatch.setattr(job, "table_from_files", lambda *a, **k: pytest.fail("the table was built again"))
    areas = job.run_job(spark, folder, str(files / "out"), folds=2, params=QUICK, run=run)
    assert trained == [1] and sorted(r.fold for r in areas.collect()) == [0, 1]
    scores = tables.read_table(spark, f"{files}/out/submission", "submission").collect()
    assert sorted(r.id for r in scores) == list(range(1000, 1040))
    assert not exists(spark, Manifest(spark, run).folder)


def test_a_saved_model_scores_as_before(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, i % 2, float(i % 7 < 3), Vectors.dense(i % 7, rng.random())) for i in range(60)]
    schema = StructType().add("id", IntegerType()).add("fold", IntegerType()).add("label", DoubleType()).add("features", VectorUDT())
    matrix = spark.createDataFrame(rows, schema)
    fitted = model.train_fold(matrix, 0, QUICK)
    again = model.load_model(str(tmp_path / "m"), model.save_model(fitted, str(tmp_path / "m")))
    assert len(again.rounds) == len(fitted.rounds) > 0
    before, after = (sorted((r.id, r.p) for r in model.score(x, matrix).collect()) for x in (fitted, again))
    assert before == after


def test_manifest_entries_hold_for_their_settings(spark, tmp_path):
    m = Manifest(spark, f"m-{tmp_path.name}", "a")
    first = m.stage("t", lambda: spark.range(3)).collect()
    assert m.stage("t", lambda: pytest.fail("built again")).collect() == first
    other = Manifest(spark, f"m-{tmp_path.name}", "b")
    assert other.find("t") is None and other.stage("t", lambda: spark.range(5)).count() == 5
    spark.range(2).write.parquet(m.new_path("half"))  # written but not noted
    assert m.find("half") is None and m.find("t") is not None
    m.close()
    assert m.find("t") is None
    with pytest.raises(ValueError, match="name"):
        Manifest(spark, "../elsewhere")


def test_files_state_changes_with_the_files(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a\n1\n")
    before = files_state(spark, [str(path)])
    assert files_state(spark, [str(path)]) == before
    path.write_text("a\n1\n2\n")
    assert files_state(spark, [str(path)]) != before
