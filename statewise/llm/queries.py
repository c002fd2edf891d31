"""One query per operator over its whole table, with SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statewise.llm import sql
from statewise.llm.alignment import align_and_score
from statewise.llm.decontaminate import contamination
from statewise.llm.exact_copies import exact_copies
from statewise.llm.fixity import audit_pages
from statewise.llm.html_text import extract_text
from statewise.llm.line_spread import remove_shared_lines
from statewise.llm.manifest import audit_documents
from statewise.llm.mixing import mix
from statewise.llm.ngram_join import near_duplicates
from statewise.llm.preferences import mask_text, preference_pairs, with_other_answers
from statewise.llm.repetition import repetition_measures
from statewise.llm.suffixes import remove_repeats
from statewise.llm.toxicity import score_toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_preference_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as chosen, against its twin with another's answer."""
    chosen = _table(spark, folder, "conversations")
    pairs = preference_pairs(chosen, with_other_answers(chosen))
    return pairs.withColumns(
        {"chosen_mask": mask_text("chosen_mask"), "rejected_mask": mask_text("rejected_mask")}
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(_table(spark, folder, "documents"))


def op3_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """All pages against a replica in which a hash of the id picks the faults."""
    pick = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    damaged = F.when(pick == "00", F.concat("html", F.lit("?"))).otherwise(F.col("html"))
    return audit_pages(_table(spark, folder, "pages"), damaged, pick == "01")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_shared_lines(_table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"))


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_table(spark, folder, "documents")).drop("runs", "kept")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition_measures(_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return audit_documents(_table(spark, folder, "documents"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_and_score(_table(spark, folder, "documents"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies(_table(spark, folder, "documents"))


QUERIES = {
    "op1_preference_format": op1_preference_format,
    "op2_mix_sources": op2_mix_sources,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_text": op5_html_text,
    "op6_ngram_join": op6_ngram_join,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_alignment": op12_token_alignment,
    "op13_exact_dedup": op13_exact_dedup,
}

SQL = {
    "op1_preference_format": sql.PREFERENCES,
    "op3_warc_fixity": sql.FIXITY,
    "op2_mix_sources": sql.MIXING,
    "op4_line_dedup": sql.LINE_SPREAD,
    "op9_benchmark_decontamination": sql.CONTAMINATION,
    "op10_quality_rules": sql.repetition(),
    "op11_merkle_manifest": sql.MANIFEST,
    "op13_exact_dedup": sql.EXACT_COPIES,
}
