"""Maintain lists of taxa: the priority taxa, and all taxa of a kingdom."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.joins import keep_absent, keep_present, one_per_key
from reknit.operators.rows import Snapshot
from reknit.operators.upsert import add_to_list, insert_ignore

TAXREF = "taxonomie.taxref"
NAMES = "taxonomie.bib_noms"
LISTS = "taxonomie.bib_listes"
LIST_NAMES = "taxonomie.cor_nom_liste"
PRIORITIES = "pr_conservation_strategy.t_priority_taxon"


def add_priority_taxa(snapshot: Snapshot, marker: str, code: str = "PRIORITY_FLORA") -> Snapshot:
    """Add the priority taxa to the names with a marker, and all marked names to the list."""
    taxa = one_per_key(keep_present(snapshot[TAXREF], snapshot[PRIORITIES], "cd_nom").select(
        "cd_nom", "cd_ref", F.col("nom_vern").alias("nom_francais")), ["cd_nom"])
    names = insert_ignore(
        snapshot[NAMES], taxa.withColumn("comments", F.lit(marker)), ["cd_nom"],
        id="id_nom", order=["cd_nom"])
    members = names.filter(F.col("comments") == marker)
    return {**snapshot, NAMES: names,
            LIST_NAMES: add_to_list(snapshot[LIST_NAMES], members, snapshot[LISTS], code, "id_nom")}


def add_kingdom_list(snapshot: Snapshot, row: DataFrame, code: str, kingdom: str, today: date
                     ) -> Snapshot:
    """Add a list (``row``, unless its code exists) with all names of a kingdom, adding these."""
    lists = insert_ignore(snapshot[LISTS], row, ["code_liste"], id="id_liste",
                          order=["code_liste"])
    taxa = snapshot[TAXREF].filter(F.col("regne") == kingdom).select("cd_nom", "cd_ref")
    new = keep_absent(taxa, snapshot[NAMES], ["cd_nom", "cd_ref"]).withColumn(
        "comments", F.lit(f"Added for {code} list - {today.isoformat()}"))
    names = insert_ignore(snapshot[NAMES], new, ["cd_nom"], id="id_nom", order=["cd_nom"])
    members = keep_present(names, taxa, ["cd_nom", "cd_ref"])
    return {**snapshot, LISTS: lists, NAMES: names,
            LIST_NAMES: add_to_list(snapshot[LIST_NAMES], members, lists, code, "id_nom")}
