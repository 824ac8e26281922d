"""One query per operator, over its whole table, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from measlake.llm import (
    ann,
    dialogue,
    exact_topk,
    extract,
    licenses,
    mixing,
    packing,
    periods,
    quality,
    repeats,
    secrets,
    sharding,
    simhash,
)
from measlake.llm.common import kept, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def word_tokenizer() -> str:
    """Path of the tokenizer the sequences are made for."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), word_tokenizer()))


@query("op2_secret_scans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_exact_topk", exact_topk.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


@query("op5_approximate_neighbours")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


@query("op6_source_mixing", mixing.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = kept(docs.select("doc_id", "source", mixing.words().alias("size")), "mix-sizes")
    return mixing.mix(sizes).drop("source")


@query("op7_suffix_array_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.cut_repeats(table(spark, sf_dir, "documents")))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


@query("op10_license_scans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.find_licenses(table(spark, sf_dir, "documents")))


@query("op11_html_extraction")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.digest(extract.main_texts(table(spark, sf_dir, "pages")))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.find_runs(periods.with_repeats(table(spark, sf_dir, "documents"))))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.digest(table(spark, sf_dir, "conversations"))
