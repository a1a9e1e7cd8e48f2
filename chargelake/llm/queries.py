"""One registered query per corpus operator, over the whole of its table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake.llm import (
    bpe, ctw, decontaminate, language, lexical, near_dup, neighbours, packing, resampling, secrets, sharding, surrogates, warc,
)
from chargelake.llm.common import table
from chargelake.llm.oracles import ORACLES  # noqa: F401
from chargelake.staging import scratch_path, staged


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("chargelake.surrogate.key", "0f6b1d1e5c7a4e0e")  # a deployment sets its own secret
    return surrogates.with_surrogates(table(spark, sf_dir, "documents"), key)


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = language.fold("doc_id", 5) == 1
    found = ctw.score(docs, docs.filter(~held_out), depth=6)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        (-F.col("score") * F.lit(math.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map for 23 shards is stored, edited for one more, and read again; ``first_shard`` is where a row lay before."""
    rows, maps = staged(sharding.slotted(table(spark, sf_dir, "documents")), "slotted"), scratch_path(spark, "slot_maps")
    first = sharding.edit_map(rows, maps, 23).select("virtual_slot", F.col("shard").alias("first_shard"))
    latest = sharding.edit_map(rows, maps, 24)
    found = sharding.placed(rows, latest).join(F.broadcast(first), "virtual_slot")  # a row per slot
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "first_shard")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.fold("doc_id", 4) == 2
    model = language.learn(docs.filter(~held_out))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    component = F.col("component.id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = [rule.kind for rule in secrets.BASE_RULES]
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_bundles(warc.archive(table(spark, sf_dir, "pages")))
    return read.select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words",
        F.size("places").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("places") > 0).alias("contaminated"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexical.small_batches(spark)
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def vocabulary_path(spark: SparkSession) -> str:
    """The tokenizer file that ``chargelake.bpe.vocabulary`` names; unless set, that of the public tokenizers package."""
    named = spark.conf.get("chargelake.bpe.vocabulary", "")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path(spark)
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_surrogates": op1_surrogates,
    "op2_context_tree": op2_context_tree,
    "op3_cross_polytope": op3_cross_polytope,
    "op4_virtual_slots": op4_virtual_slots,
    "op5_language_id": op5_language_id,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_secret_scan": op7_secret_scan,
    "op8_warc_bundles": op8_warc_bundles,
    "op9_decontamination": op9_decontamination,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_impact_search": op11_impact_search,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_byte_pairs": op13_byte_pairs,
}
