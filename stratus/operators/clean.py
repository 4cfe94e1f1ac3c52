"""Range-based outlier cleaning, flagging and confidence scoring (spec-driven)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.functions.jsonfields import DOC_KEYS, parse_doc, to_double


def out_of_range(x: Column, lo: float, hi: float) -> Column:
    """``x < lo OR x > hi`` with SQL three-valued logic: bounds are valid, NULL is never flagged."""
    return (x < F.lit(float(lo))) | (x > F.lit(float(hi)))


def json_field_present(df: DataFrame, raw_col: str = "raw", key: str = spec.REQUIRED_FIELD) -> DataFrame:
    """Keep rows whose document has ``key`` with a non-null value (missing key and JSON null both drop)."""
    return df.filter(parse_doc(raw_col, (key,)).getField(key).isNotNull())


def with_parsed_measures(df: DataFrame, raw_col: str = "raw", prefix: str = "_v_") -> DataFrame:
    """Parse the document once; add ``_v_<measure>`` (double, unparseable -> NULL) and ``_t_<text key>`` columns."""
    doc = parse_doc(raw_col, DOC_KEYS)
    out = df.withColumn("_doc", doc)
    cols = [to_double(F.col("_doc").getField(m)).alias(prefix + m) for m in spec.MEASURE_NAMES]
    cols += [F.col("_doc").getField(k).alias("_t_" + k) for k, _ in spec.TEXT_FIELDS]
    cols.append(F.col("_doc").getField(spec.REQUIRED_FIELD).isNotNull().alias("_t_present"))
    return out.select("*", *cols).drop("_doc")


def null_if_outlier(x: Column, m: spec.Measure) -> Column:
    return F.when(out_of_range(x, m.lo, m.hi), F.lit(None).cast("double")).otherwise(x)


def outlier_flag(values: dict[str, Column], measures=spec.MEASURES) -> Column:
    """Code of the first out-of-range measure in spec order, else NULL."""
    return F.coalesce(*[F.when(out_of_range(values[m.name], m.lo, m.hi), F.lit(m.flag)) for m in measures])


def confidence_score(values: dict[str, Column]) -> Column:
    keys = spec.CONFIDENCE_MEASURES
    any_out = None
    any_null = None
    for k in keys:
        m = spec.BY_NAME[k]
        o = out_of_range(values[k], m.lo, m.hi)
        n = values[k].isNull()
        any_out = o if any_out is None else (any_out | o)
        any_null = n if any_null is None else (any_null | n)
    return (F.when(any_out, F.lit(spec.CONFIDENCE_OUTLIER))
            .when(any_null, F.lit(spec.CONFIDENCE_MISSING))
            .otherwise(F.lit(spec.CONFIDENCE_OK)))


def standardize(df: DataFrame, raw_col: str = "raw", extra_cols=("batch_id",)) -> DataFrame:
    """Raw document rows -> the staged shape: nulled outliers, text fields, flag and confidence score,
    plus ``_present`` (the document has a non-null temperature) when asked for in ``extra_cols``.

    The document is parsed once per row; every CASE below reads the parsed struct.
    """
    parsed = with_parsed_measures(df, raw_col)
    v = {m: F.col("_v_" + m) for m in spec.MEASURE_NAMES}
    out = [F.col("wmo_station_id"), F.col("timestamp_utc")]
    out += [null_if_outlier(v[m.name], m).alias(m.name) for m in spec.MEASURES]
    out += [F.col("_t_" + k).alias(c) for k, c in spec.TEXT_FIELDS]
    out += [F.col("bright_sky_source_mapping"), F.col("record_source"), F.col("load_dts")]
    out += [outlier_flag(v).alias("outlier_flag"), confidence_score(v).alias("confidence_score")]
    for c in extra_cols:
        if c == "_present":
            # the raw text is present and non-null (a present-but-unparseable value still counts, as in
            # ``raw->>'temperature' IS NOT NULL``)
            out.append(F.col("_t_present").alias("_present"))
        elif c in df.columns:
            out.append(F.col(c))
    return parsed.select(*out)


def bad_measures(raw_col: str = "raw") -> Column:
    """Names of the measures that a document has a value for that is not a number."""
    doc = parse_doc(raw_col, spec.MEASURE_NAMES)
    bad = [F.when(doc.getField(m).isNotNull() & to_double(doc.getField(m)).isNull(), F.lit(m)) for m in spec.MEASURE_NAMES]
    return F.filter(F.array(*bad), lambda x: x.isNotNull())


def quarantine_unparseable(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Rows whose document holds a measure value that is present but not a number.

    The reference aborts the whole query on such text; here they are reported instead (``bad_keys``).
    """
    return df.withColumn("bad_keys", bad_measures(raw_col)).filter(F.size("bad_keys") > 0)
