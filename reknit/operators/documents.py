"""Grouping child rows into JSON, and storing them in documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.functions.documents import json_holds_object, json_set
from reknit.operators.joins import update_from


def group_pairs(children: DataFrame, parent: str, key: str, value: str, out: str) -> DataFrame:
    """Per parent, a JSON array of {key: value} objects in key order; a NULL key raises.

    The array is one cell of the result, so it has to fit in memory: a parent's own
    children, not their rows elsewhere, set that size.
    """
    pairs = F.collect_list(F.struct(F.col(key).alias("key"), F.col(value).alias("value")))
    objects = F.transform(F.sort_array(pairs),
                          lambda pair: F.create_map(pair["key"].cast("string"), pair["value"]))
    return children.groupBy(parent).agg(F.to_json(objects).alias(out))


def enrich_json(target: DataFrame, children: DataFrame, parent: str, key: str, value: str,
                target_key: Column | str, document: str, path: list[str], field: str,
                merge: bool = False, strict_null: bool = False) -> DataFrame:
    """Store grouped children as {field: […]} at a path of the target's document.

    What was at the path is replaced; with ``merge`` its other fields stay. A merge into a
    document without an object there starts from {}, unless ``strict_null`` makes the whole
    document NULL.
    """
    grouped = group_pairs(children, parent, key, value, "__items")
    old, items = F.col(f"target.{document}"), F.col("source.__items")
    new = json_set(old, path, F.concat(F.lit("{%s:" % json.dumps(field, ensure_ascii=False)), items, F.lit("}")))
    if merge:
        new = F.when(json_holds_object(old, *path), json_set(old, [*path, field], items)
                     ).when(F.lit(not strict_null), new)
    return update_from(target, grouped, [(target_key, parent)], {document: new}, unique=True)
