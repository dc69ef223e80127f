"""Registered queries of the text operators over the tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import collocations, licenses, reputation
from .common import keep, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .imatch import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches and a replay: every document is loaded with the counts of
    one tokenizer, every count is revised to those of the next, and all but the
    first of the rows with equal texts are deleted (first by id, rows without
    id last, then by source, language and number of the row: repeated rows
    and rows without id are copies like any other)."""
    import public_tokenizers

    from .rollups import Rollup, signed, token_counts

    old, new = "byte_bpe_50k", "byte_bpe_multi_50k"
    versions = {old: public_tokenizers.path("byte_bpe_50k.json"), new: public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}
    counts = keep(token_counts(table(spark, sf_dir, "documents"), versions), "counts")
    wide = counts.groupBy("doc_id", "source", "lang", "text_key").agg(
        (F.count("*") / 2).cast("long").alias("rows"), F.max(F.when(F.col("tokenizer") == old, F.col("tokens"))).alias("was"),
        F.max(F.when(F.col("tokenizer") == new, F.col("tokens"))).alias("now"))
    wide = keep(wide.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))), "revised")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang", "row")       # of no two rows of a text the same
    first = keep(wide.groupBy("text_key").agg(F.min(place).alias("first")), "first")      # a plain scan: the join below can split a hot text

    def event(op, version, tokens, had=None, were=None):
        none = F.lit(None)
        return [F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("tokenizer"), F.col(tokens).alias("tokens"),
                *[(F.col(c) if had else none).cast("string").alias(f"old_{c}") for c in ("source", "lang")],
                F.lit(had).cast("string").alias("old_tokenizer"), (F.col(were) if were else none).cast("long").alias("old_tokens")]

    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("load", signed(wide.select(*event("insert", old, "was"))))
    revision = signed(wide.select(*event("revise", new, "now", old, "was")))
    rollup.commit("revise", revision)
    rollup.compact()
    rollup.commit("revise", revision)                   # a replay: changes nothing
    copies = wide.join(first, "text_key").where(~place.eqNullSafe(F.col("first")))
    rollup.commit("copies", signed(copies.select(*event("delete", new, "now"))))
    return rollup.totals()


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = reputation.judge(table(spark, sf_dir, "pages"), reputation.outcomes_from_labels(table(spark, sf_dir, "labels")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.default_known(spark))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import grades_from_labels, score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, grades_from_labels(docs, table(spark, sf_dir, "labels"))))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_two_fit

    return best_two_fit(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest

    return digest(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import periodic_runs, run_digests, with_planted_runs

    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op4_token_counts": op4_token_counts,
    "op3_url_reputation": op3_url_reputation,
    "op5_license_scan": op5_license_scan,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_toxicity": op8_toxicity,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_quality_classifier": op13_quality_classifier,
}

ORACLE: dict[str, str] = {
    "op3_url_reputation": reputation.oracle(),
    "op5_license_scan": licenses.oracle(),
    "op12_phrase_collocations": collocations.oracle(),
}
