"""The corpus pipeline: toxicity, near duplicates, secrets, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns of documents.  ``run`` applies them to
the table ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.mixing import in_mixed_order, pfair_mix
from reportlake.llm.near_duplicates import digest
from reportlake.llm.order_minhash import order_minhash_classes
from reportlake.llm.packing import in_file_order, pack_documents
from reportlake.llm.secret_scan import redact_secrets
from reportlake.llm.toxicity import score_documents, train_on
from reportlake.session import stage

#: A recurrent network, near-duplicate classes, span positions, block schedules and
#: best fit have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ..., and those names by the old ones.

    Whatever columns documents have, none meets a name that an operator uses.
    """
    plain = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*plain), dict(zip(docs.columns, plain))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold.

    The network learns from the labels of ``sf_dir`` for documents that are not held
    out.  Null and empty texts are not toxic.  All columns and rows kept are unchanged.
    """
    net = train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain, at = aside(docs)
    kept = score_documents(plain, net, at["doc_id"], at["text"]).where("toxicity = 0")
    return kept.select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near duplicates: the one with the least id.

    Of rows equal in id and text one stays.  Empty and null texts are one class.
    """
    plain, at = aside(docs)
    doc_id = at["doc_id"]
    classes = stage(order_minhash_classes(plain, doc_id, at["text"]), "classes")
    kept = classes.where("is_kept").select(F.col(doc_id).alias("__id"), F.col("digest").alias("__kept"))
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    found = plain.withColumn("__digest", digest(at["text"])).join(kept, same, "left_semi")
    if not classes.groupBy(doc_id, "digest").count().where("count > 1").isEmpty():
        found = found.dropDuplicates([doc_id, "__digest"])  # only where a row is repeated
    return found.select(*plain.columns).toDF(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark; n_chars follows.  No row goes."""
    plain, at = aside(docs)
    text, n_chars = F.col(at["text"]), F.col(at["n_chars"])
    clean = redact_secrets(plain, text_col=at["text"])
    return clean.withColumn(at["n_chars"], F.when(text.isNull(), n_chars).otherwise(F.length(text).cast("long"))).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources mix to the target weights."""
    plain, at = aside(docs)
    mixed = pfair_mix(plain, id_col=at["doc_id"], source_col=at["source"])
    return in_mixed_order(mixed).select(*plain.columns).toDF(*docs.columns)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document.

    Documents are packed by runs of their order in the files, which is the mixture, and
    the bins of a run come before those of the next one.
    """
    places = in_file_order(docs.select("doc_id", "text", "source"), "__place")
    return pack_documents(places, place_col="__place")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
