"""Strict JSON by built-in expressions: what Spark's readers take beyond it is found by parsing a text inside of others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from annospark.functions.text import strip


_STRICT = {"allowSingleQuotes": "false"}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_json(text: Column, numbers: bool = True) -> Column:
    """Whether a text is one JSON value and nothing else. Readers stop after the first value; inside of an array and
    inside of an object what follows is an error in one of the two at least. NaN and Infinity count as ``numbers`` says."""
    options = _STRICT | {"allowNonNumericNumbers": str(numbers).lower()}
    inside = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", options)
    field = F.from_json(F.concat(F.lit('{"x":'), text, F.lit(',"y":1}')), "struct<x:string,y:int>", options)
    return F.coalesce((F.size(inside) == 1) & (field["y"] == 1), F.lit(False))


def variant(text: Column) -> Column:
    """The value of a text that is JSON without repeated keys, else null."""
    return F.when(is_json(text), F.try_parse_json(text))


def told(text: Column, whole: Column, parsed: Column) -> Column:
    """``problem`` of a stripped text, of which it is known whether it is one JSON value, and its variant."""
    broken = F.when(~whole, "not_json").when(~is_json(text, numbers=False), "not_a_number").otherwise("repeated_key")
    return F.when(parsed.isNull() | ~whole, broken)


def problem(text: Column) -> Column:
    """not_json for what isn't one JSON value; not_a_number for NaN or Infinity in one; repeated_key for objects that have
    a key twice, at any depth; else null. Null counts as empty."""
    own = strip(F.coalesce(text, F.lit("")))
    return told(own, is_json(own), F.try_parse_json(own))


def kind(value: Column) -> Column:
    """bool, int, float, string, object, list or null of a variant. Numbers with a decimal point count as float even
    where they are whole; those a variant keeps as such are told by ``number`` from their text."""
    return bound(F.schema_of_variant(value), _named)


def _named(name: Column) -> Column:
    return (
        F.when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "list")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "bool")
        .when(name == "BIGINT", "int")
        .when(name == "VOID", "null")
        .otherwise("float")
    )
