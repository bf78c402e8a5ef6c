"""Record construction: pulled rows (T5-T9, T11) and tombstones.

A pulled row becomes one flat JSON object: every source column as text, then the
metadata keys, which win over a source column of the same name. NULL values are
left out of the JSON (the original serialiser omits null entries), ``lsn`` included.
The struct is built per table, because its columns are known when the plan is made.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import META_KEYS, STATE_DELETE, STATE_INSERT
from .names import dt_value, update_time_text


def _alias_rule(rules, dbid: str, schema: str, table: str):
    for dbids, r_schema, r_table, from_c, to_c in rules:
        if str(dbid) in dbids and schema == r_schema and table == r_table:
            return from_c, to_c
    return None


def record_fields(columns: list[str], schema: str, table: str, record_table: str, dbid: str,
                  run_ts: str, texts: dict[str, Column], alias_rules=(), data_state: int = STATE_INSERT) -> list[Column]:
    """Named columns of one record, in JSON key order, from the texts of the source's columns."""
    src = [c for c in columns if c not in META_KEYS]
    fields: dict[str, Column] = {c: texts[c] for c in src}
    rule = _alias_rule(alias_rules, dbid, schema, table)
    if rule and rule[0] in src:
        from_c, to_c = rule
        alias_val = texts[from_c]
        if to_c not in fields:
            fields[to_c] = alias_val                      # NULL is elided like any other
        elif src.index(to_c) < src.index(from_c):
            # the alias is put after the real column: it wins whenever it is non-null
            fields[to_c] = F.coalesce(alias_val, fields[to_c])
        # else the real column is put last and wins
    out = [v.alias(k) for k, v in fields.items()]
    out += [
        F.lit(record_table).alias("tableName"),
        dt_value(run_ts).alias("dt"),
        update_time_text(run_ts).alias("update_time"),
        F.lit(str(dbid)).alias("dbid"),
        F.lit(None).cast("string").alias("lsn"),
        F.lit(data_state).alias("data_state"),
    ]
    return out


def record_value(fields: list[Column]) -> Column:
    """One JSON object per row; NULL fields are omitted by ``to_json`` on a struct."""
    return F.to_json(F.struct(*fields))


def decoded_event_map(c_stm: Column, d_xgsj_text: Column, c_baah: Column, n_jbfy: Column,
                      schema_name: Column) -> Column:
    """The known event fields as a map, for events whose text the variant parser rejects
    (e.g. a repeated key, which the event decoder resolves as last-wins)."""
    return F.create_map(F.lit("c_stm"), c_stm.cast("variant"), F.lit("d_xgsj"), d_xgsj_text.cast("variant"),
                        F.lit("c_baah"), c_baah.cast("variant"), F.lit("n_jbfy"), n_jbfy.cast("variant"),
                        F.lit("schemaName"), schema_name.cast("variant"))


def event_members(value: Column) -> Column:
    """The members of an event's JSON object as a map of variants, unknown ones included.

    The variant parser takes most texts. What it rejects (a repeated key, single quotes) is read member by member by the event
    decoder's parser; of a repeated key the last value counts, as there. Members that are themselves no valid variant keep
    their JSON text.
    """
    def last_of(entries: Column) -> Column:
        later = lambda i: F.slice(entries, i + 2, F.size(entries))
        return F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(later(i), lambda x: x["key"] == e["key"])))

    typed = F.map_entries(F.from_json(value, "map<string,variant>"))
    texts = F.transform(F.map_entries(F.from_json(value, "map<string,string>")),
                        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("variant").alias("value")))
    return F.coalesce(F.try_parse_json(value).try_cast("map<string,variant>"), last_of(typed), last_of(texts))


def tombstone_value(value: Column, table_name: Column, run_ts: str, dbid: str,
                    fallback: Column | None = None) -> Column:
    """The event's own JSON object (unknown fields and JSON types kept) plus metadata.

    Metadata keys replace event keys of the same name; JSON nulls are dropped.
    ``fallback`` (``decoded_event_map``) is used when no parser finds an object in the text.
    """
    m = event_members(value)
    if fallback is not None:
        m = F.coalesce(m, fallback)
    meta_names = F.array(*[F.lit(k) for k in META_KEYS])
    kept = F.map_filter(m, lambda k, v: ~F.array_contains(meta_names, k) & v.isNotNull() & ~F.is_variant_null(v))
    meta = F.create_map(
        F.lit("tableName"), table_name.cast("variant"),
        F.lit("dt"), dt_value(run_ts).cast("variant"),
        F.lit("update_time"), update_time_text(run_ts).cast("variant"),
        F.lit("dbid"), F.lit(str(dbid)).cast("variant"),
        F.lit("data_state"), F.lit(STATE_DELETE).cast("variant"),
    )
    return F.to_json(F.map_concat(kept, meta))
