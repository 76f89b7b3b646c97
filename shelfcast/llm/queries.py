"""The queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import frames, language, ledger, merge_counts, mixing, pitman_yor, positive_unlabelled, search, site_lines, spelling, tiling, token_groups, url_reputation

#: Shares of the token budget by domain.
TARGETS = {"high": 0.94, "low": 0.05, "toxic": 0.01}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.label_domains(_table(spark, sf_dir, "labels"))
    return mixing.mix(_table(spark, sf_dir, "documents"), labelled, TARGETS)


def op2_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.linked_classes(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document its path names by number: bad if of low quality or toxic."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_reputation.path_of(F.col("url")), r"/(\d{1,18})(?:[./]|$)", 1)
    named = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull())
    labels = _table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long").alias("bad"))
    return url_reputation.judge_urls(pages, named.join(labels, "doc_id").select("page_id", "bad"))


def op4_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "covered", "item_words", "tiles")


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary())


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.token_files(_table(spark, sf_dir, "documents"), vocabulary())


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ledger.judged(_table(spark, sf_dir, "documents"))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_upper", "n_lower", "failed")


def rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects."""
    return ledger.ablation(ledger.ledger(_table(spark, sf_dir, "documents")))


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    docs = pages.select(F.col("page_id").alias("doc_id"), url_reputation.host_of(F.col("url")).alias("host"), site_lines.html_lines(F.col("html")).alias("text"))
    return site_lines.drop_boilerplate(docs).withColumnRenamed("doc_id", "page_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_table(spark, sf_dir, "documents"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positive_unlabelled.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_token_groups, op3_url_reputation, op4_tiling, op5_pitman_yor, op6_language, op7_token_counts, op8_token_files, op9_quality_ledger, rule_ablation,
        op10_site_lines, op11_spelling, op12_search, op13_quality,
    )
}
