"""Registered queries of this package: name -> (Spark callable, SQL text or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from offerwise.llm import (
    bpe, collocations, fingerprints, jaccard, langid, licenses, packing, quality, repeats, runs, secrets, toxicity, urls,
)
from offerwise.llm.common import prepare, read_documents

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, text: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = (build, text)
        return build

    return add


@register("op1_secrets")
def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_documents(spark, sf_dir))


@register("op5_licenses")
def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read_documents(spark, sf_dir))


@register("op6_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@register("op3_quality", quality.SQL)
def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_documents(spark, sf_dir))


@register("op8_langid")
def _langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@register("op9_urls", urls.SQL)
def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_pages(prepare(spark).read.parquet(f"{sf_dir}/pages.parquet"))


@register("op2_fingerprints")
def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read_documents(spark, sf_dir))


@register("op4_repeats")
def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_documents(spark, sf_dir))


@register("op7_bpe")
def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(read_documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@register("op10_jaccard")
def _jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read_documents(spark, sf_dir))


@register("op13_runs")
def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(read_documents(spark, sf_dir))


@register("op11_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return toxicity.toxicity_report(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register("op12_collocations")
def _collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_documents(spark, sf_dir))
