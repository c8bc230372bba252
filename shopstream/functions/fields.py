"""Predicates and edits on JSON-like records held in maps and structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: operation name used while a table's history is replayed.
REPLAYED_INSERT = "bootstrap-insert"


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def is_entry_page(page: Column) -> Column:
    """True when the visitor came from no other page."""
    return is_blank(page["last_page_id"])


def is_page(page: Column) -> Column:
    """True when the page carries an id."""
    return ~is_blank(page["page_id"])


def non_null_entries(data: Column) -> Column:
    """A VARIANT map without entries that are JSON null."""
    return F.map_filter(data, lambda _, v: ~F.coalesce(F.is_variant_null(v), F.lit(True)))


def has_content(data: Column) -> Column:
    """True for an object that prints as more than ``{}`` once nulls are left out."""
    return F.coalesce(F.exists(F.map_values(data), lambda v: ~F.coalesce(F.is_variant_null(v), F.lit(True))), F.lit(False))


def normalize_op(op: Column) -> Column:
    """Rows replayed from history count as inserts."""
    return F.when(op == REPLAYED_INSERT, F.lit("insert")).otherwise(op)


def project_columns(data: Column, columns: Column) -> Column:
    """Keep the listed keys of a map.

    ``columns`` is a comma list taken as is: blanks around a name belong to the
    name. Null or empty keeps everything.
    """
    wanted = F.split(columns, ",")
    return F.when(is_blank(columns), data).otherwise(
        F.map_filter(data, lambda k, _: F.array_contains(wanted, k))
    )


def text_map(data: Column) -> Column:
    """VARIANT map to string map; keys with JSON null stay, with a null value."""
    return F.transform_values(data, lambda _, v: v.cast("string"))


def to_json_line(record: Column, kind: str = "struct") -> Column:
    """One record as JSON text, without null fields.

    ``kind="map"`` is for VARIANT maps, whose nulls the JSON writer would print.
    """
    return F.to_json(non_null_entries(record) if kind == "map" else record)


# ``common`` in either kind of quotes up to the value of its ``is_new``, past strings and one level of nested objects.
_STRING = r"""(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+')"""
_FLAG = (
    r"""((?:"common"|'common')\s*:\s*\{(?:[^{}"']|""" + _STRING + r"""|\{(?:[^{}"']++|""" + _STRING + r""")*+\})*?"""
    r"""(?:"is_new"|'is_new')\s*:\s*)(?:"1"|'1'|1(?![0-9.eE]))"""
)


def last_of_repeated(entries: Column) -> Column:
    """A map without the earlier entries of keys that occur more than once."""
    keys = F.map_keys(entries)
    count = F.size(keys)
    last = F.filter(F.map_entries(entries), lambda e, i: F.array_position(F.reverse(keys), e["key"]) == count - i)
    return F.when(F.size(F.array_distinct(keys)) == count, entries).otherwise(F.map_from_entries(last))


def with_flag(value: Column, flag: Column) -> Column:
    """The record text with ``common.is_new`` replaced; everything else is kept.

    Text that is no strict JSON (repeated keys, single quotes) keeps its form:
    only the flag in it is replaced, where it can be told. Never null for a value.
    """
    plain = F.regexp_replace(value, F.lit(_FLAG), F.concat(F.lit('$1"'), flag, F.lit('"')))
    return F.coalesce(_rewritten(value, flag), plain, value)


def _rewritten(value: Column, flag: Column) -> Column:
    record = F.try_parse_json(value).cast("map<string, variant>")
    common = F.map_filter(record["common"].cast("map<string, variant>"), lambda k, _: k != "is_new")
    new_flag = F.create_map(F.lit("is_new"), flag.cast("variant"))
    new_common = F.to_variant_object(F.map_concat(common, new_flag))
    rest = F.map_filter(record, lambda k, _: k != "common")
    return F.to_json(F.map_concat(rest, F.create_map(F.lit("common"), new_common)))
