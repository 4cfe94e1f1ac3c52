"""Reading typed fields out of raw JSON documents with a single parse per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.spec import MEASURE_NAMES, TEXT_FIELDS


def raw_text_schema(keys) -> T.StructType:
    """Every key read as text: a JSON number yields its literal text, a JSON string its value, JSON null
    and a missing key both yield NULL — the semantics of PostgreSQL's ``raw->>'key'``."""
    return T.StructType([T.StructField(k, T.StringType(), True) for k in keys])


DOC_KEYS = MEASURE_NAMES + tuple(k for k, _ in TEXT_FIELDS)
DOC_SCHEMA = raw_text_schema(DOC_KEYS)


def parse_doc(raw: Column | str, keys=DOC_KEYS) -> Column:
    """One ``from_json`` for all keys (instead of one JSON scan per ``->>``)."""
    return F.from_json(raw if isinstance(raw, Column) else F.col(raw), raw_text_schema(keys))


def json_text(raw: Column | str, key: str) -> Column:
    """``raw->>'key'`` for a single key (text of the value, NULL when missing or JSON null)."""
    return parse_doc(raw, (key,)).getField(key)


def to_double(text: Column) -> Column:
    """``text::double precision`` that yields NULL instead of aborting on unparseable text."""
    return text.try_cast(T.DoubleType())
