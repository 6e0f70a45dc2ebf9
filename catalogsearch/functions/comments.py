"""Comment text of columns, tables, views and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogsearch.functions.binding import bind
from catalogsearch.functions.names import clean_display_name
from catalogsearch.functions.text import READ_ALL, json_string, py_literal, py_quote

CALCULATED = "This column is a Calculated Field"
JSON_TYPES = ("JSON", "JSON_ARRAY")

CommentBuilder = Callable[[Column], Column]


_KNOWN = "struct<displayName:string,description:string,uniqueValues:string,json_type:string>"
#: What a variant can hold; larger properties are taken apart as texts.
VARIANT_BYTES = 100_000_000


def _members(properties: Column, parsed: Column, keep: Callable[[Column], Column]) -> Column:
    """JSON object of the chosen members; `parsed` has those of properties within `VARIANT_BYTES`."""

    def chosen(members: Column) -> Column:
        return F.map_filter(members, lambda key, _: keep(key))

    def member(entry: Column) -> Column:
        # A text map has strings without their quotes; the properties show whether a value had any.
        key, value = json_string(entry["key"]), entry["value"]
        quoted = F.rlike(properties, F.concat(F.lit("\\Q"), key, F.lit('\\E\\s*:\\s*"')))
        return F.concat(key, F.lit(":"), F.when(quoted, json_string(value)).otherwise(F.coalesce(value, F.lit("null"))))

    strings = F.from_json(properties, "map<string,string>", READ_ALL)
    texts = bind(F.map_entries(chosen(strings)), lambda m: F.array_join(F.transform(m, member), ","))
    large = F.concat(F.lit("{"), texts, F.lit("}"))
    return F.when(F.octet_length(properties) > VARIANT_BYTES, large).otherwise(F.to_json(chosen(parsed)))


def _labelled(label: str, raw: Column) -> Column:
    return F.concat(F.lit(f'"{label}":'), raw)


def _non_empty(text: Column) -> Column:
    return bind(text, lambda t: F.when(t != "", json_string(t)))


def _pieces(properties: Column, known: Column) -> Column:
    values, json_type = known["uniqueValues"], known["json_type"]
    has_nested, is_json = F.contains(properties, F.lit('"nested')), json_type.isin(*JSON_TYPES)

    def pieces(parsed: Column) -> Column:
        nested = _members(properties, parsed, lambda key: key.startswith("nested"))
        json_fields = _members(properties, parsed, lambda key: F.contains(key, F.lit("json")))
        return F.concat_ws(
            ",",
            _labelled("alias", _non_empty(clean_display_name(known["displayName"]))),
            _labelled("description", _non_empty(known["description"])),
            F.when(values.startswith("[") & (values != "[]"), _labelled("uniqueValues", values)),
            F.when(has_nested, bind(nested, lambda m: F.when(m != "{}", _labelled("nested_columns", m)))),
            F.when(
                is_json,
                F.concat(_labelled("json_type", json_string(json_type)), F.lit(","), _labelled("json_fields", json_fields)),
            ),
        )

    # The members are taken apart once, and only where some may be shown.
    wanted = (has_nested | is_json) & (F.octet_length(properties) <= VARIANT_BYTES)
    return bind(F.when(wanted, F.from_json(properties, "map<string,variant>", READ_ALL)), pieces)


def properties_comment(properties: Column) -> Column:
    """`-- {json}` with the non-empty properties of a column; an empty string if there are none.

    The pieces are joined as JSON text, so that a long value list is copied and never taken apart.
    """
    pieces = bind(F.from_json(properties, _KNOWN, READ_ALL), lambda known: _pieces(properties, known))
    shown = bind(pieces, lambda p: F.when(p != "", F.concat(F.lit("-- {"), p, F.lit("}\n  "))).otherwise(""))
    return F.when(properties.isNotNull(), shown).otherwise("")


def calculated_comment(is_calculated: Column, expression: Column) -> Column:
    """Two lines that show the expression of a calculated column."""
    return F.when(
        F.coalesce(is_calculated, F.lit(False)),
        F.concat(
            F.lit(f"-- {CALCULATED}\n  -- column expression: "), F.coalesce(expression, F.lit("")), F.lit("\n  ")
        ),
    ).otherwise("")


def column_comment(column: Column, extra: tuple[CommentBuilder, ...] = ()) -> Column:
    """Comment of one MDL column; `extra` builders take the column struct and add their text."""
    return F.concat(
        properties_comment(column["properties"]),
        calculated_comment(column["isCalculated"], column["expression"]),
        *[F.coalesce(build(column), F.lit("")) for build in extra],
    )


def model_comment(properties: Column) -> Column:
    """Alias and description of a table."""

    def shown(known: Column) -> Column:
        alias = F.coalesce(clean_display_name(known["displayName"]), F.lit(""))
        description = F.coalesce(known["description"], F.lit(""))
        return F.concat(
            F.lit("\n/* {'alias': "), py_quote(alias), F.lit(", 'description': "), py_quote(description), F.lit("} */\n")
        )

    return bind(F.from_json(properties, _KNOWN, READ_ALL), shown)


def view_comment(properties: Column) -> Column:
    """All properties of a view; nothing if it has none."""
    return F.when(
        properties.isNotNull(), F.concat(F.lit("/* "), py_literal(properties), F.lit(" */\n"))
    ).otherwise("")


def metric_comment(base_object: Column) -> Column:
    """Marks a metric and names its base."""
    return F.concat(
        F.lit("\n/* This table is a metric */\n/* Metric Base Object: "),
        F.coalesce(base_object, F.lit("")),
        F.lit(" */\n"),
    )


def relation_comment(condition: Column, join_type: Column) -> Column:
    """Condition and join type of a relation."""
    return F.concat(
        F.lit('-- {"condition": '), condition, F.lit(', "joinType": '), join_type, F.lit("}\n  ")
    )


DIMENSION_COMMENT = "-- This column is a dimension\n  "


def measure_comment(expression: Column) -> Column:
    """Marks a measure and shows its expression."""
    return F.concat(
        F.lit("-- This column is a measure\n  -- expression: "), F.coalesce(expression, F.lit("")), F.lit("\n  ")
    )
