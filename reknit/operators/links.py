"""Link tables from delimited lists, codes and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.functions.documents import json_set
from reknit.functions.lists import explode_list, explode_together, split_list
from reknit.functions.text import person_key, squash
from reknit.operators.joins import keep_absent, measured, own_shuffle, update_from
from reknit.session import BROADCAST_BYTES, broadcast_if_small, materialize, measure

# A task makes about so many links from codes; the bytes it reads say nothing of their number.
LINKS = 2_000_000
# Of one code, so many rows of either side meet at once where the dimension is not broadcast.
SIDE = 1_000


def codes_to_links(df: DataFrame, id: str, codes: str, dimension: DataFrame, code: str, value: str,
                   mapping: DataFrame | None = None, source: str = "source_code",
                   standard: str = "standard_code", type_column: str | None = None,
                   type_name: str | None = None) -> DataFrame:
    """Distinct (id, value) links from a comma list of codes.

    A code is looked up as it is and, given a mapping, as its standard code as well. Codes of
    every type match unless a type is named. Rows are dealt by the number of links they make.
    """
    if type_column is not None:
        dimension = dimension.filter(F.col(type_column) == type_name)
    known = dimension.select(code, value)
    if mapping is not None:
        # Both are small beside the lists: the dimension is put under the other codes as well.
        other = mapping.select(F.col(standard).alias(code), F.col(source).alias("__source"))
        known = known.union(known.join(other, code).select("__source", value))
    known = materialize(known.distinct(), "known")
    listed = explode_list(df.select(id, codes), codes, code).select(id, code)
    # Codes that nothing bears count as well, as they have to be read.
    sizes = materialize(
        listed.groupBy(code).agg(F.count("*").alias("__listed")).join(own_shuffle(
            known.groupBy(code).agg(F.count("*").alias("__known")), [code]), code, "left")
        .fillna(1, ["__known"]), "sizes")
    links = sizes.agg(F.sum(F.col("__listed") * F.col("__known"))).first()[0] or 0
    tasks, size = links // LINKS + 1, measure(known)
    if size <= BROADCAST_BYTES:
        # All codes of an id are in one task, where its links become distinct without a shuffle.
        listed = listed.distinct().repartition(tasks, id)
        found = listed.join(broadcast_if_small(known, size), code)
    else:
        found = _by_cells(listed.distinct(), known, id, code, value, sizes, tasks)
    return found.select(id, value).distinct()


def _by_cells(listed: DataFrame, known: DataFrame, id: str, code: str, value: str,
              sizes: DataFrame, tasks: int) -> DataFrame:
    """Join (id, code) and (code, value) in cells of a code, of about SIDE rows by SIDE rows.

    A code of many rows has its ids in blocks and its values in blocks, and every pair of blocks
    is a cell. So neither a code with many ids nor one with many values is left to one task.
    """
    blocks = sizes.select(code, *(F.ceil(F.col(f"__{side}") / SIDE).alias(f"__{side}")
                                  for side in ("listed", "known")))
    blocks = measured(blocks.filter("__listed > 1 OR __known > 1"), [code])

    def dealt(rows: DataFrame, column: str, own: str, other: str) -> DataFrame:
        rows = rows.join(blocks, code, "left").fillna(1, ["__listed", "__known"])
        return (rows.withColumn("__own", F.pmod(F.xxhash64(column), F.col(f"__{own}")))
                .withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"),
                                                            F.col(f"__{other}") - 1)))
                .select(code, column, F.col("__own").alias(f"__{own}"),
                        F.col("__other").alias(f"__{other}"))
                .repartition(tasks, code, "__listed", "__known"))

    return dealt(listed, id, "listed", "known").join(
        dealt(known, value, "known", "listed"), [code, "__listed", "__known"])


def links_from_id_list(df: DataFrame, ids: str, key: str, targets: DataFrame, target_key: str,
                       target_id: str, people: DataFrame, person_id: str, partner_id: Column
                       ) -> DataFrame:
    """Links between target rows and people from a comma list of partner ids.

    ``partner_id`` is where a person keeps the id the partner uses, as text.
    """
    listed = explode_list(df.select(key, ids), ids, "__partner").select(key, "__partner")
    known = people.select(partner_id.alias("__partner"), F.col(person_id))
    return (listed.join(targets.select(F.col(target_key).alias(key), target_id), key)
            .join(known, "__partner").select(target_id, person_id))


def missing_links(df: DataFrame, id: str, names: str, links: DataFrame, people: DataFrame,
                  person_id: str, first: str, last: str) -> DataFrame:
    """(id, person) for listed names that no linked person bears.

    Names are compared by their keys; a name that several people bear links them all.
    """
    keyed = materialize(people.select(person_id, person_key(first, last).alias("__name")), "names")
    keyed = broadcast_if_small(keyed, measure(keyed))
    # Split before normalising, so that items without accents are left alone. Items are never
    # NULL; saying so spares a filter that would normalise them once more.
    items = explode_list(df.select(id, names), names, "__item", trim=False)
    name = F.coalesce(squash("__item"), F.lit(""))
    # Names that nobody bears go before anything is shuffled to meet the links.
    listed = items.select(id, name.alias("__name")).join(keyed, "__name")
    linked = links.join(keyed, person_id).select(id, "__name")
    return keep_absent(listed, linked, [id, "__name"]).select(id, person_id).distinct()


def link_missing_observers(people: DataFrame, partner_people: DataFrame, zones: DataFrame,
                           common: DataFrame, index: Column, ids: str, names: str,
                           person_id: str, first: str, last: str, document: str,
                           path: list[str], field: str) -> DataFrame:
    """Store the partner's id on people the partner knows only from its lists.

    ``zones`` hold two lists, ids and names, in step. Listed people whom the partner has a
    row for are left out, and so are zones whose ``index`` is among ``common``'s. The others
    are matched by name key, and {field: id} is set at the path of their document. When a
    name has several ids, the smallest is stored.
    """
    listed = explode_together(
        zones.select(index.alias("__index"), F.col(ids).alias("__ids"),
                     F.col(names).alias("__names")),
        {"__id": split_list("__ids"), "__name": split_list("__names")})
    listed = keep_absent(listed.select(F.col("__id").cast("long").alias("__id"),
                                       F.trim("__name").alias("__name"), "__index"),
                         partner_people, [("__id", person_id)])
    listed = keep_absent(listed, common, [("__index", "__index")])
    unknown = listed.select("__id", squash("__name").alias("__name")).distinct()
    new = json_set(F.col(f"target.{document}"), path,
                   F.to_json(F.struct(F.col("source.__id").alias(field)),
                             {"ignoreNullFields": "false"}))
    return update_from(people, unknown, [(person_key(first, last), "__name")], {document: new},
                       order=["__id"])
