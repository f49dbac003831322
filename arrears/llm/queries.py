"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.session import work_dir
from arrears.llm import (
    chat,
    decontaminate,
    divergence,
    exact_dedup,
    html_text,
    interaction,
    jaccard_join,
    maxent,
    packing,
    quality,
    secrets,
    url_filter,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "n_links", "kept")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judged(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page.page_id", "host", "path", "rule", "verdict")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.checksums(packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Fixed value: the conversation that the contract adds.
    said = "</s>[INST] ok [/INST]"
    turns = [F.struct(F.lit(i).alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))]
    added = spark.range(1).select(F.lit(-7).alias("conv_id"), F.inline(F.array(*turns)), F.lit(said).alias("text"))
    made = chat.format_turns(chat.turns_of_rows(table.union(added)))
    read = made.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("pieces")).alias("loss")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor))


def op6_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.language_scores(_table(spark, sf_dir, "documents"), _remainder("doc_id", 10) == 0)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_versions(docs, f"{work_dir(spark)}/llm/ledger-{uuid.uuid4().hex}")
    base = [rule.kind for rule in secrets.BASE]
    return found.select(
        "version.doc_id",
        *(F.size(_of_kinds([kind])).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(_joined(_of_kinds(base)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _of_kinds(kinds: list[str]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = f"{work_dir(spark)}/llm/archives-{uuid.uuid4().hex}"
    warc.write_archives(_table(spark, sf_dir, "pages"), archives)
    return warc.capture_index(spark, archives).select(
        warc.id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.id_of(F.col("refers_to")).alias("refers_to"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learnt = labels.where(_remainder("doc_id", 5) != 0)
    model = quality.fit(docs, learnt)
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page.page_id", "page.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_report(_table(spark, sf_dir, "documents"))


def op13_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = interaction.mask_counts(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))
    return interaction.interactions(counts)


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``op3_url_filter`` that SQL can express: host, path and the rule that fits."""
    found = url_filter.judged(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page.page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


def base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``op6_maxent`` that SQL can express: everything but the model's score."""
    return op6_maxent(spark, sf_dir).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 3).alias("base_score")
    )


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``op7_secrets`` that SQL can express: base matches of each kind."""
    return op7_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_url_filter": op3_url_filter,
    "op4_packing": op4_packing,
    "op5_chat": op5_chat,
    "op6_maxent": op6_maxent,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality": op10_quality,
    "op11_html_text": op11_html_text,
    "op12_divergence": op12_divergence,
    "op13_interaction": op13_interaction,
    "url_rules": url_rules,
    "base_scores": base_scores,
    "secret_counts": secret_counts,
}
