"""Migrating organisms, their people, and the groups these belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.functions.documents import iso_timestamp, json_nested
from reknit.functions.text import blank_to_null, clean_phone, upper_or_null
from reknit.operators.joins import keep_absent, keep_absent_any, keep_present, update_from
from reknit.operators.rows import append


def _members(links: DataFrame, groups: Sequence[int]) -> DataFrame:
    return links.filter(F.col("id_role_groupe").isin(list(groups))).select("id_role_utilisateur")


def migrate_organisms(organisms: DataFrame, roles: DataFrame, links: DataFrame, target: DataFrame,
                      groups: Sequence[int]) -> DataFrame:
    """Add the cleaned organisms that have a member in one of the groups.

    An organism stays out when the target knows its id or its name in upper case. The joins
    to members are semi joins, so an organism is never multiplied by its members.
    """
    present = keep_present(roles.select("id_role", "id_organisme"), _members(links, groups),
                           [("id_role", "id_role_utilisateur")])
    chosen = keep_present(organisms, present, "id_organisme")
    chosen = keep_absent_any(
        chosen, target, "id_organisme",
        [(F.upper("nom_organisme"), F.upper("nom_organisme"))])
    cleaned = chosen.select(
        "id_organisme", "nom_organisme",
        blank_to_null("adresse_organisme").alias("adresse_organisme"),
        blank_to_null("cp_organisme").alias("cp_organisme"),
        upper_or_null("ville_organisme").alias("ville_organisme"),
        clean_phone("tel_organisme").alias("tel_organisme"),
        clean_phone("fax_organisme").alias("fax_organisme"),
        blank_to_null("email_organisme").alias("email_organisme"),
    ).distinct()
    return append(target, cleaned)


def migrate_roles(roles: DataFrame, links: DataFrame, target: DataFrame, groups: Sequence[int],
                  remark: str) -> DataFrame:
    """Add the cleaned members of the groups and the groups themselves.

    A role stays out when the target knows its id, or its name and first name in upper case.
    """
    members = _members(links, groups).dropna().distinct().withColumn("__member", F.lit(True))
    chosen = (roles.join(members, F.col("id_role") == F.col("id_role_utilisateur"), "left")
              .filter(F.col("__member") | F.col("id_role").isin(list(groups))))
    chosen = keep_absent_any(
        chosen, target, "id_role",
        [(F.upper("nom_role"), F.upper("nom_role")),
         (F.upper("prenom_role"), F.upper("prenom_role"))])
    cleaned = chosen.select(
        "id_role", "groupe",
        blank_to_null("identifiant").alias("identifiant"),
        upper_or_null("nom_role").alias("nom_role"),
        blank_to_null("prenom_role").alias("prenom_role"),
        blank_to_null("desc_role").alias("desc_role"),
        blank_to_null("pass").alias("pass"),
        blank_to_null("email").alias("email"),
        "id_organisme",
        F.lit(remark).alias("remarques"),
        F.lit(True).alias("active"),
    ).distinct()
    return append(target, cleaned)


def attach_provenance(target: DataFrame, source: DataFrame, on: str, document: str, name: str,
                      fields: dict[str, Column]) -> DataFrame:
    """Store where matched rows came from as {name: {field: value, …}}, NULLs kept.

    Timestamps of either type are written without zone, to the microsecond.
    """
    kinds = dict(source.select(*[value.alias(key) for key, value in fields.items()]).dtypes)
    fields = {key: iso_timestamp(value) if kinds[key].startswith("timestamp") else value
              for key, value in fields.items()}
    built = source.select(on, json_nested(name, **fields).alias("__provenance"))
    return update_from(target, built, on, {document: F.col("source.__provenance")})


def assign_group(roles: DataFrame, links: DataFrame, group: int | Column, condition: Column,
                 only_ungrouped: bool = False) -> DataFrame:
    """Add links from a group to the roles that meet a condition.

    With ``only_ungrouped``, roles that are in any group already stay as they are.
    """
    new = roles.filter(condition)
    if only_ungrouped:
        grouped = links.filter(F.col("id_role_groupe").isNotNull())
        new = keep_absent(new, grouped, [("id_role", "id_role_utilisateur")])
    group = group if isinstance(group, Column) else F.lit(group)
    return append(links, new.select(group.alias("id_role_groupe"),
                                    F.col("id_role").alias("id_role_utilisateur")))


def has_password(column: str = "pass") -> Column:
    """Not NULL, or not empty: true for the empty text as well."""
    return F.col(column).isNotNull() | (F.col(column) != "")


def lacks_password(column: str = "pass") -> Column:
    return F.col(column).isNull() | (F.col(column) == "")
