"""The whole job: six delimited files in, scored offers and feature importance out."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from offerwise.functions.codes import CATEGORIES
from offerwise.operators.campaigns import prepare_campaigns
from offerwise.operators.lines import add_items, describe_lines
from offerwise.operators.offers import union_train_test
from offerwise.plans import model
from offerwise.plans.training_table import feature_columns, text_features, training_table
from offerwise.sources.manifest import Manifest, files_state
from offerwise.sources.staging import release, stage
from offerwise.sources.tables import read_campaigns, read_table, write_importance, write_scores

# The input files, by the names of their schemas.
INPUTS = ("customer_transaction_data", "item_data", "campaign_data", "coupon_item_mapping", "train", "test")


def table_from_files(
    spark: SparkSession, folder: str, categories: Sequence[str] = CATEGORIES, **recency
) -> tuple[DataFrame, DataFrame]:
    """The training table from ``folder/<name>.csv`` for each of the input names, and the items."""
    tables = {n: read_table(spark, f"{folder}/{n}.csv", n) for n in INPUTS if n != "campaign_data"}
    campaign = stage(read_campaigns(spark, f"{folder}/campaign_data.csv"), "campaigns")
    item = stage(tables["item_data"], "items")
    lines = describe_lines(add_items(tables["customer_transaction_data"], item), categories)
    offers = stage(union_train_test(tables["train"], tables["test"]), "offers")
    table = training_table(
        offers, lines, campaign, prepare_campaigns(campaign), tables["coupon_item_mapping"], item, categories, **recency
    )
    return table, item


def run_job(
    spark: SparkSession,
    folder: str,
    out: str,
    folds: int = model.FOLDS,
    params: Mapping | None = None,
    categories: Sequence[str] = CATEGORIES,
    run: str | None = None,
    **recency,
) -> DataFrame:
    """Write ``out/submission`` and ``out/importance``; return the ROC area of each fold.

    What the run has staged is released at the end. Under a name (``run``) the training table, the
    matrices and each fold's model are kept until the results are written: a second attempt with the
    same files and settings starts with what the first had finished.
    """
    manifest = None
    if run is not None:
        files = files_state(spark, [f"{folder}/{n}.csv" for n in INPUTS])
        settings = [folder, files, folds, params, list(categories), recency]
        manifest = Manifest(spark, run, json.dumps(settings, sort_keys=True, default=str))

    def table_() -> DataFrame:
        table, item = table_from_files(spark, folder, categories, **recency)
        table = stage(table, "job-table")
        text = text_features(table)
        return model.index_text(table, text, item.select("brand")) if text else table

    try:
        table = manifest.stage("table", table_) if manifest else table_()
        fitted = model.redemption_scores(table, feature_columns(table), folds, params, manifest)
        write_scores(fitted.scores, f"{out}/submission")
        per_fold = model.fold_importance(fitted.models, fitted.features, spark, fitted.flags)
        write_importance(model.mean_importance(per_fold), f"{out}/importance")
        areas = model.auc(fitted.held, "p", "label", ["fold"]).collect()  # one row a fold
    finally:
        release(spark)
    if manifest:
        manifest.close()
    return spark.createDataFrame([tuple(r) for r in areas], "fold int, auc double")
