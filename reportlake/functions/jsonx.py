"""JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_json_ok(text: Column) -> Column:
    """True when ``text`` is exactly one JSON value.

    Spark's JSON readers stop after the first complete value and ignore what
    follows (``{"k":1}}}`` parses), and ``from_json`` turns unreadable text into
    a struct of nulls.  Here the text is wrapped as ``[text, 0]`` and its
    elements are counted with the streaming ``json_array_length``: trailing text
    breaks the array, a comma-separated list counts more than two elements.
    The streaming count has no size limit, unlike a VARIANT parse.
    """
    wrapped = F.concat(F.lit("["), text, F.lit("\n,0]"))
    return F.coalesce(F.call_function("json_array_length", wrapped) == 2, F.lit(False))
