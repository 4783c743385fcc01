"""Registered queries of the operators, and their DuckDB SQL.

``queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``; each applies
its operator to the whole table with the operator's own defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm import (
    class_lm,
    decontaminate,
    edit_counts,
    oracles,
    packing,
    pseudonyms,
    quality,
    resample,
    secrets,
    simhash_dedup,
    spelling,
    toxicity,
    warc,
    wavelet,
)
from layerkit.llm.common import table
from layerkit.session import scratch_path


# The pseudonym key of the registered query and the pipeline; production runs
# pass their own.
DEMO_KEY = "layerkit-demo-key"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), packing.word_lengths(F.col("text")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_documents(spark, sf_dir))
    spans, base = F.col("spans"), [r.kind for r in secrets.BASE_RULES]
    of_base = F.filter(spans, lambda s: s["kind"].isin(base))
    of_kind = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[of_kind(k) for k in base],
        F.sha2(secrets.digest(of_base), 256).alias("base_sha256"),
        secrets.digest(spans).alias("spans"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", simhash_dedup.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.scores(_documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash", "distance")


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", pseudonyms.replace(F.col("text"), DEMO_KEY).alias("done"))
    found = [F.col("done.found")[k].alias(f"n_{k}") for k in pseudonyms.KINDS]
    return docs.select("doc_id", *found, F.col("done.text").alias("text"))


def op8_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    wavelet.write_corpus(_documents(spark, sf_dir), path)
    return wavelet.read_documents(spark, path)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, m, kept = quality.judge(_documents(spark, sf_dir), drop_text=True)
    return out.select(
        "doc_id",
        *[F.col(m)[k].alias(k) for k in quality.BASE],
        quality.base_failed(F.col(m)).alias("base_failed"),
        F.col(kept).alias("kept"),
    )


def three_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and what ``grown_and_edited`` makes of three edits of every
    document, at places drawn from its id: a deletion, an insertion, a
    replacement."""
    docs = _documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.length("text") + 1).cast("int")
    edit = lambda at, n, new: F.struct(at.alias("start"), (at + n).alias("end"), F.lit(new).alias("text"))
    edits = F.array(edit(place(1), 20, ""), edit(place(2), 0, " counts follow edits "), edit(place(3), 7, "spliced"))
    return docs.select("doc_id", edit_counts.grown_and_edited(F.col("text"), edits).alias("done"))


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return three_edits(spark, sf_dir).select(
        "doc_id",
        "done.n_before",
        "done.n_after",
        "done.encoded_chars",
        F.crc32(F.col("done.text").cast("binary")).alias("text_crc32"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.scores(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    # payloads are held against the digests of their headers, and not returned
    of_pages = F.col("record_type").isin("response", "revisit")
    found = warc.read_archives(spark, path, of_pages, payload=False, verify=True)
    return found.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(spelling.word_counts(_documents(spark, sf_dir)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    done = (
        op1_best_fit_packing,
        op2_secret_scan,
        op3_toxicity,
        op4_simhash_dedup,
        op5_class_lm,
        op6_decontamination,
        op7_pseudonyms,
        op8_wavelet_files,
        op9_quality_rules,
        op10_edit_counts,
        op11_importance_resampling,
        op12_warc,
        op13_spelling_variants,
    )
    return {f.__name__: f for f in done}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
