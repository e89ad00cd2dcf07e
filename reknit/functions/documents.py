"""JSON documents held as text.

The steps of a path are names of fields, or, where an array is met, whole numbers: its elements
from 0 on, and from -1 on backwards. An object is never met by position: there the text of a
number is a name like any other. Results are written with sorted keys and no spaces, numbers in their shortest form.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS, ITEMS = "map<string,variant>", "array<variant>"

Step = str | int

# Timestamps keep their microseconds; ``iso_timestamp`` writes them in their shortest form.
_WHOLE_TIMES = {name: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
                for name in ("timestampFormat", "timestampNTZFormat")}
_KEEP_NULLS = {"ignoreNullFields": "false", **_WHOLE_TIMES}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_object(**fields: Column) -> Column:
    """A JSON object from columns; NULL values stay as null."""
    struct = F.struct(*[_col(value).alias(name) for name, value in fields.items()])
    return F.to_json(struct, _KEEP_NULLS)


def json_nested(name: str, **fields: Column) -> Column:
    """{name: {field: value, …}}, NULL values kept."""
    inner = F.struct(*[_col(value).alias(key) for key, value in fields.items()])
    return F.to_json(F.struct(inner.alias(name)), _KEEP_NULLS)


def iso_timestamp(value: Column | str) -> Column:
    """A timestamp as ISO 8601 text with as many decimals as it has, and without a zone.

    The databases read here hold timestamps without zone, which Spark reads into either of
    its two types.
    """
    return F.replace(_col(value).cast("string"), F.lit(" "), F.lit("T"))


def json_pair(key: Column | str, value: Column | str) -> Column:
    """{key: value} with the key taken from a column; a NULL key raises."""
    return F.to_json(F.create_map(_col(key).cast("string"), _col(value)), _WHOLE_TIMES)


def json_text(document: Column | str, *path: Step) -> Column:
    """The text at a path: strings without quotes, NULL where absent or null."""
    if not _stepwise(path):
        return F.get_json_object(_col(document), _path(path))
    return _bind(_at(document, path), _text)


def _text(value: Column) -> Column:
    return (F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
            .when(F.schema_of_variant(value) != "VOID", F.to_json(value)))


def json_typed(document: Column | str, *path: Step) -> Column:
    """The value at a path as canonical JSON: 5 differs from "5", null from absent (NULL).

    Numbers that are equal are written alike, as 100 for 1e2 and 100.0.
    """
    return _bind(F.to_json(_at(document, path)), _number)


def _number(text: Column) -> Column:
    """The text of a JSON value, that of a number with a point or an exponent in plain form.

    Such a number is written as a decimal where it fits one, else as a double; integers are
    exact as they are.
    """
    double = text.try_cast("double")

    def plain(kind: str) -> Column:
        value = text.try_cast(kind)
        written = F.regexp_replace(value.cast("string"), r"\.?0*$", "") if kind[-3:] == "18)" \
            else value.cast("string")
        return F.when(value.cast("double") == double, F.regexp_replace(written, "^-0$", "0"))

    fitted = F.coalesce(plain("decimal(38,18)"), plain("decimal(38,0)"), double.cast("string"))
    return F.when(text.rlike("^-?[0-9].*[.eE]"), fitted).otherwise(text)


def json_holds_object(document: Column | str, *path: Step) -> Column:
    """Whether there is an object at a path."""
    return F.try_variant_get(_at(document, path), "$", FIELDS).isNotNull()


def _stepwise(path: tuple[Step, ...]) -> bool:
    """Whether a path needs more than the names that Spark's own paths can hold."""
    return any("'" in str(step) or _position(step) is not None for step in path)


def _path(path: tuple[Step, ...]) -> str:
    return "$" + "".join(f"['{step}']" for step in path)


def _position(step: Step) -> int | None:
    """The place in an array that a step names, if it is a whole number."""
    return int(step) if re.fullmatch(r"[+-]?[0-9]+", str(step)) else None


def _at(document: Column | str, path: tuple[Step, ...]) -> Column:
    """The variant at a path."""
    value = F.parse_json(_col(document))
    if not _stepwise(path):
        return F.variant_get(value, _path(path), "variant")
    return reduce(_inside, path, value)


def _inside(value: Column, step: Step) -> Column:
    """The variant one step further, NULL where there is none."""
    field = F.try_element_at(_fields(value), F.lit(str(step)))
    place = _position(step)
    if place is None:
        return field
    return F.coalesce(field, F.try_element_at(_items(value), F.lit(place + (place >= 0))))


def canonical(document: Column | str) -> Column:
    """The same document with sorted keys and no spaces."""
    return F.to_json(F.parse_json(_col(document)))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _fields(document: Column) -> Column:
    """The fields of an object, NULL for anything else."""
    return F.try_variant_get(document, "$", FIELDS)


def _items(document: Column) -> Column:
    """The elements of an array, NULL for anything else."""
    return F.try_variant_get(document, "$", ITEMS)


def json_merge(left: Column | str, right: Column | str) -> Column:
    """Two documents as one; NULL when either is NULL.

    Objects are merged, without their inner ones, and the right side wins. Where one side is an
    array, or both are single values, the other is appended (or put before it) as an array or
    as one element. An object and a single value give NULL.
    """
    def merged(sides: Column) -> Column:
        one, other = sides["one"], sides["other"]
        kept = F.map_filter(_fields(one), lambda key, _: ~F.map_contains_key(_fields(other), key))
        objects = F.to_json(F.to_variant_object(F.map_concat(kept, _fields(other))))
        listed = F.to_json(F.to_variant_object(F.concat(*(
            F.coalesce(_items(side), F.array(side)) for side in (one, other)))))
        mixed = _fields(one).isNotNull() != _fields(other).isNotNull()
        arrays = _items(one).isNotNull() | _items(other).isNotNull()
        return F.coalesce(objects, F.when(arrays | ~mixed, listed))

    both = F.struct(F.parse_json(_col(left)).alias("one"), F.parse_json(_col(right)).alias("other"))
    return F.when(_col(left).isNotNull() & _col(right).isNotNull(), _bind(both, merged))


def json_set(document: Column | str, path: list[Step], value: Column | str) -> Column:
    """Set the JSON ``value`` at a path.

    Only the last step is created: a missing parent, or one that is neither object nor array,
    leaves the document as it is, as does a name where an array is met. In an array a last step
    beyond the end appends the value, and one before the beginning puts it first. A NULL
    document or value gives NULL.
    """
    document, value = _col(document), _col(value)
    edited = _bind(F.parse_json(document), lambda parsed: _set(parsed, list(path),
                                                               F.parse_json(value)))
    return F.when(value.isNotNull(), F.to_json(edited))


def _set(document: Column, path: list[Step], value: Column) -> Column:
    step, rest = str(path[0]), path[1:]
    place = _position(path[0])

    def edit(fields: Column) -> Column:
        new = _set(fields[step], rest, value) if rest else value
        others = F.map_filter(fields, lambda key, _: key != step)
        edited = F.to_variant_object(F.map_concat(others, F.create_map(F.lit(step), new)))
        editable = F.map_contains_key(fields, step) if rest else fields.isNotNull()
        return F.when(editable, edited).otherwise(
            document if place is None else _bind(_items(document), edit_items))

    def edit_items(items: Column) -> Column:
        index = F.lit(place) if place >= 0 else F.size(items) + place
        inside = (index >= 0) & (index < F.size(items))

        def put(item: Column, k: Column) -> Column:
            return F.when(k == index, _set(item, rest, value) if rest else value).otherwise(item)

        edited = F.when(inside, F.transform(items, put))
        if not rest:
            edited = edited.when(index < 0, F.array_prepend(items, value)).otherwise(
                F.array_append(items, value))
        return F.when(items.isNotNull(), F.coalesce(F.to_variant_object(edited), document)
                      ).otherwise(document)

    return _bind(_fields(document), edit)
