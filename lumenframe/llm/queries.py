"""The queries of this subpackage, with production parameters and over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, fingerprints, html, jaccard, langid, mixing, packing, pieces, pseudo, quality, repair, variants
from .common import load


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(load(spark, sf_dir, "documents"))


def op2_classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"))


def op3_score_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.score(load(spark, sf_dir, "documents"))


def op4_identify_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.with_languages(load(spark, sf_dir, "documents"))


def op5_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(load(spark, sf_dir, "pages"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(load(spark, sf_dir, "documents"))


def op7_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(1).select(F.inline(F.array(*(F.struct(*map(F.lit, row)) for row in chat.TRICKY)))).toDF(*rows.columns)
    return chat.read_back(chat.windows(rows.union(tricky)))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_of_edits(load(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(repair.edits(repair.damaged(load(spark, sf_dir, "conversations"))))


def op12_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(load(spark, sf_dir, "documents"))


def op13_group_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(load(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # a script at the repository's top, which need not be on the path for the other queries

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_jaccard_join, op2_classify_quality, op3_score_pseudo_likelihood, op4_identify_languages, op5_extract_text, op6_pack,
    op7_format_chats, op8_nearest, op9_fingerprints, op10_mix_sources, op11_repair_conversations, op12_encode_pieces, op13_group_variants, pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard_join": jaccard.SQL, "op7_format_chats": chat.SQL, "op10_mix_sources": mixing.SQL, "op11_repair_conversations": repair.SQL, "op13_group_variants": variants.SQL}
