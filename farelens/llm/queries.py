"""The thin ``opN_`` queries: each applies its operator to the whole table
and derives the contract's columns from what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm import bpe, chat_format, factorization, fingerprints, html_text, license_scan, ngram_join, packing, personal_data, quality_rules, turn_repair, url_filter, whitening
from farelens.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fingerprints.compare_with_next(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprints.as_text("fingerprint").alias("fingerprint"),
        fingerprints.as_text("edited_fingerprint").alias("edited_fingerprint"),
        fingerprints.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        fingerprints.likeness("fingerprint", "next_fingerprint").alias("near_next"))


def packed(docs: DataFrame) -> DataFrame:
    """The ids stay where they are made; their checksum travels."""
    pieces = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    names = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.col(c) for c in columns)))), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.place").alias("first_word"),
        F.array_max("base.place").alias("last_word"), names("base.label").alias("base_labels"), names("base.label", "best.label").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.score"), F.lit(0.0))).alias("score"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = f"{chat_format.END}{chat_format.START}assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], rows.schema))
    back = chat_format.format_chats(rows, public_tokenizers.path("byte_bpe_50k.json"), reading_back=True)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col("stats")[c].alias(c) for c in
                                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                         "base_failed", "kept", "posterior")


def held_out() -> Column:
    """Rows whose labels nothing may learn from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = factorization.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = factorization.score(docs, model, drop_text=True)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return both.select("doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("url")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = personal_data.KINDS[:4]
    return found.select("doc_id", *map(count, base), F.sha2(personal_data.listed(only=base), 256).alias("base_sha256"),
                        personal_data.listed().alias("spans"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long is an error, never a wrong number."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.fit(pages))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.repair_report(turn_repair.damaged(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_license_scan": op3_license_scan,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe": op6_bpe,
    "op7_url_filter": op7_url_filter,
    "op8_personal_data": op8_personal_data,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_html_text": op12_html_text,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE: dict[str, str] = {}
