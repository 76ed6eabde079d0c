"""Request payloads for replaying captured queries: C13, C14, C15.

A payload is built for every (module, next-page request) row at once: an equi-join of
modules with their report's config, then text: the captured template goes into the
payload as it stands, but for the paging window, which is spliced in at its place
(``functions.jsonspan``).  So numbers, key order, escapes and blanks of a query are
those of the capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.functions.jsonspan import spliced
from reportlake.functions.jsonx import strict_json_ok
from reportlake.functions.protocol import DATA_VOLUME, PAGE_SIZE, PAYLOAD_VERSION
from reportlake.session import json_parity, spread


def is_paginated(template_json: Column | str) -> Column:
    """The template's reduction is Window-shaped (null-tolerant at each level;
    a present-but-null Window counts as present)."""
    t = F.col(template_json) if isinstance(template_json, str) else template_json
    v = F.call_function("try_parse_json", t)
    return F.call_function("try_variant_get", v, F.lit("$.Binding.DataReduction.Primary.Window")).isNotNull()


def window_config(page_size: Column | int = PAGE_SIZE, restart_tokens: Column | None = None) -> Column:
    """``{"Count": page_size}`` plus ``RestartTokens`` when they are truthy (JSON text)."""
    n = page_size if isinstance(page_size, Column) else F.lit(page_size)
    count = F.call_function("parse_json", n.cast("string"))
    base = F.create_map(F.lit("Count"), count)
    if restart_tokens is None:
        return F.call_function("to_variant_object", base)
    truthy = restart_tokens.isNotNull() & ~restart_tokens.isin("null", "[]", "{}", '""', "0", "false", "0.0")
    with_tokens = F.map_concat(base, F.create_map(F.lit("RestartTokens"), F.call_function("try_parse_json", restart_tokens)))
    return F.call_function("to_variant_object", F.when(truthy, with_tokens).otherwise(base))


def apply_window(template_col: str, window_col: str) -> Column:
    """C14: the command text with ``Binding.DataReduction.Primary`` replaced by ``{"Window": w}``.

    A missing or empty ``Binding`` or ``DataReduction`` is made, the latter with
    ``"DataVolume":3``; every other character stays.  Arguments are column names of the template
    and of the window, both JSON text.  A template that is no JSON object, or has something else
    than an object on the way, gives null.
    """
    path = ("Binding", "DataReduction", "Primary")
    edited = spliced(template_col, path, window_col, ("", f"'\"DataVolume\":{DATA_VOLUME},'"))
    return F.when(strict_json_ok(F.col(template_col)), edited)


def _text(value: Column) -> Column:
    """A string as JSON text; null is ``null``."""
    listed = F.to_json(F.array(value.cast("string")))
    return F.substring(listed, 2, F.length(listed) - 2)


def build_payloads(
    requests: DataFrame,
    config: DataFrame,
    window: Column | None = None,
    paginated_only: bool = True,
) -> DataFrame:
    """C14: one payload JSON per request row.

    ``requests`` has report_key, query_template (JSON text) and any other keys;
    ``config`` the C6 columns.  When ``window`` is given (a VARIANT column, see
    ``window_config``) it is applied to paginated templates only (a single-shot
    template is replayed as captured) unless ``paginated_only`` is False.
    """
    json_parity(requests.sparkSession)
    cfg = config.select("report_key", "dataset_id", "report_id", "visual_id", "model_id")
    df = spread(requests.join(cfg, "report_key", "inner"))
    cmd = F.when(strict_json_ok(F.col("query_template")), F.col("query_template"))
    if window is not None:
        df = df.withColumn("__win", F.concat(F.lit('{"Window":'), F.to_json(window), F.lit("}")))
        edited = apply_window("query_template", "__win")
        cmd = F.when(is_paginated("query_template"), edited).otherwise(cmd) if paginated_only else edited
    # an unreadable template gives no payload (NULL) rather than a made-up command
    payload = F.concat(
        F.lit(f'{{"version":"{PAYLOAD_VERSION}","queries":[{{"Query":{{"Commands":[{{"SemanticQueryDataShapeCommand":'), cmd,
        F.lit('}]},"ApplicationContext":{"DatasetId":'), _text(F.col("dataset_id")),
        F.lit(',"Sources":[{"ReportId":'), _text(F.col("report_id")), F.lit(',"VisualId":'), _text(F.col("visual_id")),
        F.lit('}]}}],"cancelQueries":[],"modelId":'), F.coalesce(F.col("model_id").cast("string"), F.lit("null")), F.lit("}"),
    )
    return df.withColumn("payload", payload).drop("__win", "dataset_id", "report_id", "visual_id", "model_id")
