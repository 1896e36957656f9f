"""The registered queries: thin, over whole tables, with production parameters."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    compression_classifier,
    decontamination,
    jaccard_join,
    mixing,
    periodic_runs,
    quality_rules,
    sharding,
    simhash_dedup,
    spelling_variants,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
)
from tidemark.llm.common import shared_folder, table, words

#: Rules of the URL query: host, start of the path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_counts.zipf_scores(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), scores)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex[:12]}"
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer, path)

    return token_files.read_ids(spark, path, zlib.crc32, "ids_crc32 long")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return sharding.shard(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    # Counts of the texts are made once: the certificate and the verdict read the narrow cut point.
    measured = quality_rules.cut(quality_rules.with_measures(docs).drop("text"))
    cutoffs = quality_rules.certify(measured, table(spark, sf_dir, "labels"))
    judged = quality_rules.apply_cutoffs(measured, cutoffs)
    return judged.select(
        "doc_id",
        *[f"__q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    drawn = mixing.cut(docs.select("doc_id", *mixing.draw(docs, mixing.SEED)))
    mixed = mixing.with_copies(drawn, mixing.plan_mix(drawn))
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__total").alias("source_size"),
        F.col("__target").cast("double").alias("target"),
        (F.col("__copies") * F.col("__size")).cast("long").alias("taken"),
        F.col("__copies").cast("int").alias("copies"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.report(docs, table(spark, sf_dir, "benchmark"))


def op9_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression_classifier.score(docs, compression_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the end of the text of every tenth ``crc32(doc_id)`` made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, a, p, w = F.size("__w"), F.col("__a"), F.col("__p"), F.col("__w")
    g = F.floor(h / 10)
    # Null where the text stays as it is.
    frame = docs.withColumn("__w", F.when(h % 10 == 0, words(F.col("text")))).withColumn(
        "__a", F.when(n > 0, g % n).cast("int")
    )
    frame = frame.withColumn("__p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    repeats = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), repeats)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")
    return frame.select("doc_id", F.when(a.isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.collapse_runs(_with_planted_runs(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("early"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    best = {"start": -F.col("__best.early"), "length": F.col("__best.length"), "period": -F.col("__best.short")}
    return found.withColumn("__best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[c.alias(name) for name, c in best.items()],
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _planted_typo(doc_id: int | None, word: str) -> str:
    """``word`` without a code point, by a checksum of document and word; nearly always as it is."""
    h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{word}".encode())
    return word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants.variants(spelling_variants.vocabulary(docs, change=_planted_typo))


def registered() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_token_files": op2_token_files,
        "op3_sharding": op3_sharding,
        "op4_url_filter": op4_url_filter,
        "op5_quality_rules": op5_quality_rules,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_mixing": op7_mixing,
        "op8_decontamination": op8_decontamination,
        "op9_compression_classifier": op9_compression_classifier,
        "op10_simhash_dedup": op10_simhash_dedup,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_jaccard_join": op12_jaccard_join,
        "op13_spelling_variants": op13_spelling_variants,
    }
