"""Registered queries of the corpus operators and their DuckDB SQL.

Each runs its operator with production parameters over its whole table and
derives the columns of the result from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from stratus.llm import decontamination, language_id, licenses, line_dedup, lsh_forest, mixing, packing, periodic_runs, pii, pstable, spelling, \
    token_output, url_filter
from stratus.llm.common import table
from stratus.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


@register("op1_decontaminate", decontamination.ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                        F.col("n_hit").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op2_personal_data")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def joined(column: str):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def n(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in pii.KINDS], F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))


@register("op3_token_output")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-output")
    token_output.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read(spark, path)


@register("op4_url_filter")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).withColumns({
        "host_words": F.array_join("host_words", " "), "score": F.round("score", 6)})


@register("op5_license_scan", licenses.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn(
        "line_licenses", F.array_join("line_licenses", ","))


@register("op6_minhash_near_dedup", lsh_forest.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.link(table(spark, sf_dir, "documents"), shingle=4).drop("text_hash")


@register("op7_mix_sources")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        F.col("id_text").cast("long").alias("doc_id"), "size", "source_size", "target", "taken")


@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@register("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_units", "n_removed", "words_removed", F.array_join(
        F.transform("removed", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("removed"))


@register("op10_embedding_near_dedup", pstable.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.link(table(spark, sf_dir, "embeddings"))


def _repeated_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents is made to repeat some of its
    words from a place on: both chosen by the id's crc32."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("words"))
    sized = words.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    placed = sized.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    unit = F.slice("words", F.col("a") + 1, "p")
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    changed = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(unit, times))), F.lit(1), F.col("n"))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def runs_of(docs: DataFrame) -> DataFrame:
    found = periodic_runs.find(_repeated_tail(docs))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", periodic_runs.strongest("runs")).select(
        F.col("id").cast("long").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_of(table(spark, sf_dir, "documents"))


@register("op12_pack_sequences")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("part", "row")


@register("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), change=spelling.drop_letters)
