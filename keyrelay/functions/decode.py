"""Change-event decoding (T1 T2 T12 T13) and the quarantine reason.

Every field is parsed as text first so that ``"data_state":"1"`` and ``"data_state":1``
both decode (the original parser coerces), then typed with ``try_cast`` so that no
row ever raises: a bad row gets a ``reason`` instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EVENT_FIELDS

CORRUPT = "_corrupt"
EVENT_TEXT_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in EVENT_FIELDS] + [T.StructField(CORRUPT, T.StringType())]
)
_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

# Accepted modification-time text: yyyy-[m]m-[d]d hh:mm:ss[.f...] (up to nanoseconds).
D_XGSJ_FORMAT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?$"

REASONS = ("bad_json", "no_data_state", "bad_data_state", "bad_schema_name", "bad_n_jbfy", "bad_d_xgsj")


def case_type(schema_name: Column) -> Column:
    """Second '_' token of the schema name; NULL when absent or empty."""
    return F.nullif(F.split_part(schema_name, F.lit("_"), F.lit(2)), F.lit(""))


def parse_d_xgsj(text: Column) -> Column:
    """Empty or absent -> NULL; otherwise a wall-clock timestamp (NTZ) or NULL if unparsable."""
    t = F.nullif(F.trim(text), F.lit(""))
    # to a time without zone at once: no session zone can shift it or find it missing
    return F.when(t.rlike(D_XGSJ_FORMAT), t.try_cast(T.TimestampNTZType()))


def decode_events(raw: DataFrame) -> DataFrame:
    """Raw ``(seq, value[, apply_ts, run_ts])`` -> typed events plus ``reason``.

    Output columns: seq, value, c_stm, d_xgsj_text, d_xgsj, data_state, c_baah, n_jbfy,
    schema_name, ajzlx, reason, and any pass-through columns of ``raw``.
    """
    passthru = [c for c in raw.columns if c not in ("seq", "value")]
    j = F.from_json(F.col("value"), EVENT_TEXT_SCHEMA, _JSON_OPTS)
    df = raw.select("seq", "value", *passthru, j.alias("_j"))
    # the decoder stops at the end of the object; as the element of an array, text after it is an error (or a second element)
    one_value = F.coalesce(F.json_array_length(F.concat(F.lit("["), "value", F.lit("]"))) == 1, F.lit(False))
    ds_txt = F.col("_j.data_state")
    nj_txt = F.col("_j.n_jbfy")
    df = df.select(
        "seq", "value", *passthru,
        F.col("_j.c_stm").alias("c_stm"),
        F.col("_j.d_xgsj").alias("d_xgsj_text"),
        parse_d_xgsj(F.col("_j.d_xgsj")).alias("d_xgsj"),
        ds_txt.try_cast("int").alias("data_state"),
        F.col("_j.c_baah").alias("c_baah"),
        nj_txt.try_cast("int").alias("n_jbfy"),
        F.col("_j.schemaName").alias("schema_name"),
        case_type(F.col("_j.schemaName")).alias("ajzlx"),
        (F.col(f"_j.{CORRUPT}").isNotNull() | F.coalesce(F.trim("value"), F.lit("")).__eq__("") | ~one_value).alias("_bad"),
        ds_txt.alias("_ds_txt"), nj_txt.alias("_nj_txt"),
    )
    reason = (
        F.when(F.col("_bad"), F.lit("bad_json"))
        .when(F.col("_ds_txt").isNull(), F.lit("no_data_state"))
        .when(F.col("data_state").isNull(), F.lit("bad_data_state"))
        .when(F.col("ajzlx").isNull(), F.lit("bad_schema_name"))
        .when(F.col("_nj_txt").isNotNull() & F.col("n_jbfy").isNull(), F.lit("bad_n_jbfy"))
        .when(F.col("data_state").isin(1, 2) & F.nullif(F.trim("d_xgsj_text"), F.lit("")).isNotNull()
              & F.col("d_xgsj").isNull(), F.lit("bad_d_xgsj"))
    )
    return df.withColumn("reason", reason).drop("_bad", "_ds_txt", "_nj_txt")


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull())


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull())


def route(decoded_good: DataFrame) -> Column:
    """deletes become tombstones, everything else pulls rows."""
    return F.when(F.col("data_state") == 0, F.lit("tombstone")).otherwise(F.lit("pull"))
