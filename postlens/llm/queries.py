"""One thin query per operator: ``(spark, sf_dir) -> DataFrame`` with the operator's digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import ann, decontaminate, html, langid, lines, mixing, packing, quotas, repair, secrets, simhash, trie, warc
from postlens.llm.common import read


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind, *_ in secrets.BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("found")).alias("spans"),
    )


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(read(spark, sf_dir, "pages", "page_id", "url", "html"), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), modulus=20)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_shared_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair(repair.damage(turns), turns)


def op13_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotas.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_html": op2_html,
    "op3_warc": op3_warc,
    "op4_simhash": op4_simhash,
    "op5_ann": op5_ann,
    "op6_mixing": op6_mixing,
    "op7_langid": op7_langid,
    "op8_line_dedup": op8_line_dedup,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_trie": op11_trie,
    "op12_repair": op12_repair,
    "op13_quotas": op13_quotas,
}
