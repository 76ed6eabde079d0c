"""Captured browser traffic: HAR source (A1), capture filter (C1), headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.jsonx import strict_json_ok
from reportlake.functions.protocol import QUERY_PATH

HAR_DDL = (
    "log struct<entries:array<struct<request:struct<method:string,url:string,"
    "headers:array<struct<name:string,value:string>>,postData:struct<text:string>>>>>"
)


def read_har_texts(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A1: HAR files -> (source, text).  One whole file per row (a HAR is one JSON
    document); ``multiline=False`` reads one HAR document per line."""
    df = spark.read.text(path, wholetext=multiline)
    return df.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def har_problem(text_col: str = "text") -> Column:
    """A1: why a HAR text gives no entries at all: it is no JSON, or no object (NULL: it is read)."""
    t = F.col(text_col)
    return F.when(t.isNull() | ~t.rlike("^\\s*\\{") | ~strict_json_ok(t), F.lit("unreadable_har"))


def har_reports(texts: DataFrame, text_col: str = "text", key_cols: tuple[str, ...] = ("source",)) -> DataFrame:
    """One row per HAR text: keys, ``problem`` (NULL where it could be read)."""
    return texts.select(*key_cols, har_problem(text_col).alias("problem"))


def har_entries(texts: DataFrame, text_col: str = "text", key_cols: tuple[str, ...] = ("source",)) -> DataFrame:
    """A1: (keys, HAR text) -> one row per log entry, keeping its position.

    A text that is cut short or no JSON object gives no entry at all (``har_reports`` lists it)."""
    har = F.from_json(F.col(text_col), HAR_DDL)
    return (
        texts.where(har_problem(text_col).isNull()).select(*key_cols, F.posexplode_outer(har["log"]["entries"]).alias("pos", "e"))
        .where(F.col("e").isNotNull())
        .select(
            *key_cols,
            F.col("pos").cast("int").alias("pos"),
            F.col("e.request.method").alias("method"),
            F.coalesce(F.col("e.request.url"), F.lit("")).alias("url"),
            F.coalesce(F.col("e.request.headers"), F.array()).alias("headers"),
            F.col("e.request.postData.text").alias("body"),
        )
    )


def reject_reason(path_marker: str = QUERY_PATH) -> Column:
    """Why an entry is not a query capture (NULL = it is one)."""
    return (
        F.when(F.col("method").isNull() | (F.col("method") != "POST"), F.lit("not_post"))
        .when(~F.col("url").contains(path_marker), F.lit("not_query_path"))
        .when(F.col("body").isNull() | (F.col("body") == ""), F.lit("empty_body"))
        .when(~strict_json_ok(F.col("body")), F.lit("bad_json"))
    )


def filter_captures(entries: DataFrame, path_marker: str = QUERY_PATH) -> tuple[DataFrame, DataFrame]:
    """Split entries into (captures, rejects with reason).  The same rule
    applies to live-captured requests landed in this shape."""
    tagged = entries.withColumn("reject", reject_reason(path_marker))
    return tagged.where(F.col("reject").isNull()).drop("reject"), tagged.where(F.col("reject").isNotNull())


def header_value(headers: Column | str, name: str | Column) -> Column:
    """C2 + C3: case-insensitive header lookup.

    The headers are a list of (name, value); as a dict the *last* value of an
    exact name wins while the name keeps its first position; lookup returns the
    first name (in that order) equal ignoring case, or NULL.
    """
    h = F.col(headers) if isinstance(headers, str) else headers
    n = F.lit(name) if isinstance(name, str) else name
    cands = F.filter(h, lambda x: F.lower(x["name"]) == F.lower(n))
    first_name = F.get(cands, 0)["name"]
    exact = F.filter(h, lambda x: x["name"] == first_name)
    return F.when(F.size(cands) > 0, F.element_at(exact, -1)["value"])
