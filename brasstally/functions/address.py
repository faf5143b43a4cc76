"""Addresses kept as JSON text."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.text import _col, attention_name

# Keys an address may hold; others stay in the leftover map.
ADDRESS_FIELDS = ("firstName", "lastName", "email", "country", "state", "postalCode")


def parse_json_map(c: Column | str) -> Column:
    """Keys and values of a JSON object as text; null unless the whole text is one object.

    The object is read inside another whose last field must come through: what
    follows an object, or a broken one, would take that field away. As the only
    element of an array it can bring no field of its own along. Of repeated keys the
    last counts.
    """
    whole = F.from_json(F.concat(F.lit('{"v":'), _col(c), F.lit(',"end":1}')), "v map<string,string>, end int")
    alone = F.json_array_length(F.concat(F.lit("["), _col(c), F.lit("]"))) == 1
    found = F.when((whole["end"] == 1) & alone, whole["v"])
    backwards = F.reverse(F.map_entries(found))
    keys = F.transform(backwards, lambda e: e["key"])
    last = F.map_from_entries(F.filter(backwards, lambda e, i: F.array_position(keys, e["key"]) == i + 1))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last).otherwise(found)


def json_text(c: Column | str, key: str) -> Column:
    """Scalar under a top-level key, the last of repeated ones; null for an object, an array or unreadable text."""
    value = parse_json_map(c)[key]
    return F.when(~F.startswith(value, F.lit("{")) & ~F.startswith(value, F.lit("[")), value)


def swap(c: Column, fixes: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    if not fixes:
        return c
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(fixes.items())])
    return F.coalesce(F.try_element_at(table, c), c)


def flatten_address(
    df: DataFrame,
    column: str,
    prefix: str,
    *,
    countries: Mapping[str, str] | None = None,
    states: Mapping[str, str] | None = None,
    fields: tuple[str, ...] = ADDRESS_FIELDS,
) -> DataFrame:
    """``prefix_<key>`` columns, leftovers in ``prefix_other``, the name in ``prefix_attention``.

    Unreadable JSON gives nulls and keeps the row. ``countries`` and ``states``
    are short correction lists given by the caller.
    """
    parsed = df.withColumn("_address", parse_json_map(column))
    named = {f"{prefix}_{f}": F.col("_address")[f] for f in fields}
    if "country" in fields:
        named[f"{prefix}_country"] = swap(named[f"{prefix}_country"], countries or {})
    if "state" in fields:
        named[f"{prefix}_state"] = swap(named[f"{prefix}_state"], states or {})
    named[f"{prefix}_other"] = F.map_filter("_address", lambda k, _: ~k.isin(*fields))
    named[f"{prefix}_attention"] = attention_name(F.col("_address")["firstName"], F.col("_address")["lastName"])
    return parsed.withColumns(named).drop("_address")
