"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm import sql
from reportlake.llm.common import table
from reportlake.llm.filter_audit import audit_documents
from reportlake.llm.fingerprints import fingerprint_documents
from reportlake.llm.html_text import extract_main_text
from reportlake.llm.merkle import FIELDS, folded, leaf_hash, merkle_manifest, path_hash
from reportlake.llm.mixing import pfair_mix
from reportlake.llm.order_minhash import order_minhash_classes
from reportlake.llm.packing import pack_documents
from reportlake.llm.quality_classifier import quality_scores
from reportlake.llm.quality_rules import quality
from reportlake.llm.secret_scan import BASE_RULES, scan_secrets
from reportlake.llm.sharding import propagate_shards
from reportlake.llm.token_counts import count_tokens
from reportlake.llm.toxicity import held_out, score_documents, train_on


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base columns and the cascade's verdict for every document."""
    return quality(table(spark, sf_dir, "documents"))


def _listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kinds(kinds: list[str]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all secrets in every document, with the digest of the base kinds."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in BASE_RULES]
    return found.select(
        "doc_id",
        *[F.size(_of_kinds([k])).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(_listed(_of_kinds(kinds)), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 bytes and tokens of every document."""
    import public_tokenizers  # the vocabulary files; no other operator needs them

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of all documents; copies of a text and documents of a source lie in different bins."""
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness to each other and the next document."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document; one row of each class is kept."""
    return order_minhash_classes(table(spark, sf_dir, "documents")).drop("digest")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a network trained on labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    net = train_on(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity_score").alias("score"), F.col("toxicity").alias("predicted"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 of even counts, copies together where the counts allow."""
    return propagate_shards(table(spark, sf_dir, "documents"), 40)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mixture of all sources to tempered weights."""
    return pfair_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "mix_block", "mix_place", "mix_release", "mix_deadline", "mix_slot")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from trusted good documents and unlabelled ones."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from the documents of a language, in every order of the filters."""
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that its row gives after tampering.

    Tampering deletes the line ends of texts whose id has an even checksum; a null id has none.
    """
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    altered = leaf_hash([text if f == "text" else F.col(f) for f in FIELDS])
    found = merkle_manifest(table(spark, sf_dir, "documents"), carry={"altered": altered})
    found = found.select("doc_id", "leaf", "subroot", "root", path_hash(F.col("path")).alias("proof_sha256"),
                         folded(F.col("altered"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_order_minhash": op6_order_minhash,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_html_text": op10_html_text,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL: dict[str, str] = {
    "op12_filter_audit": sql.AUDIT,
    "op13_merkle_manifest": sql.MERKLE,
}
