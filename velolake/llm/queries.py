"""The operators as named queries over the given tables, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm import collocations, exact, jaccard, langid, lines, mixing, packing, passages, periods, quality, suffixes, topk, warc
from velolake.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_totals(table(spark, sf_dir, "documents"))


def op2_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_strings(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(spark, table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.dedup_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digests(periods.periodic_runs(periods.planted(table(spark, sf_dir, "documents"))))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_threshold_topk": op2_threshold_topk,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_zip_warc": op7_zip_warc,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
    "op11_seed_extend": op11_seed_extend,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op2_threshold_topk": topk.ORACLE,
    "op7_zip_warc": warc.ORACLE,
    "op8_exact_dedup": exact.ORACLE,
    "op11_seed_extend": passages.ORACLE,
    "op12_periodic_runs": periods.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
