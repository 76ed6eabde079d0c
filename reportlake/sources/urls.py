"""Report-view URLs: text source (A3), URL extraction (C4), resource keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportlake.functions.protocol import VIEW_URL_PREFIX
from reportlake.functions.ranking import group_row_number


def view_url_pattern(prefix: str = VIEW_URL_PREFIX) -> str:
    """Java regex for view URLs: the prefix, then a run of characters that are
    not whitespace (Unicode-aware, plus the information separators U+001C..1F
    that Python also treats as space), quotes or angle brackets."""
    return "(?U)" + re.escape(prefix) + "[^\\s\\x{1c}-\\x{1f}\"'<>]+"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A3: whole text files -> (source, text)."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def extract_view_urls(texts: DataFrame, prefix: str = VIEW_URL_PREFIX, order_cols: tuple[str, ...] = ("source",)) -> DataFrame:
    """C4: distinct URLs, each with the position of its first occurrence.

    Output (url, first_seen struct(order_cols..., match index)); order by
    ``first_seen`` for the first-seen order.  De-duplication is an aggregate
    (partial on the map side), so a URL repeated everywhere is no hot spot.
    """
    pat = view_url_pattern(prefix)
    matches = texts.select(
        *order_cols, F.posexplode_outer(F.regexp_extract_all(F.col("text"), F.lit(pat), F.lit(0))).alias("idx", "url")
    ).where(F.col("url").isNotNull())
    return matches.groupBy("url").agg(F.min(F.struct(*order_cols, "idx")).alias("first_seen"))


def numbered_urls(urls: DataFrame) -> DataFrame:
    """``extract_view_urls`` over texts with their source: (url, url_index), counted in order of first appearance.

    URLs are numbered within their source, and sources (text files) one after the other by name.
    """
    at = urls.select("url", F.col("first_seen.source").alias("source"), F.col("first_seen.idx").alias("idx"))
    ranked = group_row_number(at, ["source"], "idx", "nth")
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    start = at.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select("source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ranked.join(start, "source").select("url", (F.col("start") + F.col("nth")).alias("url_index"))


def resource_key(url: Column | str) -> tuple[Column, Column]:
    """Decode the ``r`` query parameter -> (key, reason).

    ``r`` is URL-decoded with a literal ``+`` kept (deviation V8: form decoding
    would turn it into a space and corrupt the base64), padded, base64-decoded,
    parsed as JSON; the key is its ``k``.  Characters outside the base64 alphabet are
    passed over, and what follows a complete padding is not read, as lenient decoders
    do.  Failures give NULL and a reason.
    """
    u = F.col(url) if isinstance(url, str) else url
    r_raw = F.call_function("try_parse_url", u, F.lit("QUERY"), F.lit("r"))
    r = F.call_function("try_url_decode", F.replace(r_raw, F.lit("+"), F.lit("%2B")))

    def binary(plain: Column) -> Column:
        ended = F.regexp_extract(plain, "^((?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=))", 1)
        whole = F.when(plain.rlike("^(?:[A-Za-z0-9+/]{4})*+=*$"), F.rtrim(plain, F.lit("=")))
        return F.call_function("try_to_binary", F.when(ended != "", ended).otherwise(whole), F.lit("base64"))

    def found(r: Column, raw: Column, parsed: Column, key_v: Column) -> Column:
        key = F.when(
            F.call_function("schema_of_variant", key_v) == "STRING", F.call_function("try_variant_get", key_v, F.lit("$"), F.lit("string"))
        ).otherwise(F.call_function("to_json", key_v))
        reason = (
            F.when(r.isNull() | (r == ""), F.lit("no_r_param"))
            .when(raw.isNull(), F.lit("bad_base64"))
            .when(parsed.isNull(), F.lit("bad_json"))
            .when(key_v.isNull(), F.lit("no_k"))
        )
        return F.struct(F.when(reason.isNull(), key).alias("key"), reason.alias("reason"))

    def padded(r: Column) -> Column:
        return F.concat(r, F.call_function("repeat", F.lit("="), F.pmod(-F.length(r), F.lit(4))))

    # each step is bound, so that it is worked out once and not again in every step that reads it
    out = _bind(r, lambda r: _bind(
        F.regexp_replace(padded(r), "[^A-Za-z0-9+/=]", ""), lambda plain: _bind(
            binary(plain), lambda raw: _bind(
                F.call_function("try_parse_json", raw.cast("string")), lambda parsed: _bind(
                    F.call_function("try_variant_get", parsed, F.lit("$.k")), lambda key_v: found(r, raw, parsed, key_v))))))
    return out["key"], out["reason"]


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)
