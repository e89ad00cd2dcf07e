"""Bring the people, zones and areas of a partner's database into the snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reknit.functions.documents import json_nested, json_text, json_typed
from reknit.operators.joins import scalar_lookup
from reknit.operators.links import (
    codes_to_links, link_missing_observers, links_from_id_list, missing_links)
from reknit.operators.people import assign_group
from reknit.operators.rows import Snapshot, append
from reknit.operators.upsert import insert_children, insert_missing, overwrite_matched
from reknit.session import materialize
from reknit.sources.tables import values

ORGANISMS = "utilisateurs.bib_organismes"
ROLES = "utilisateurs.t_roles"
GROUPS = "utilisateurs.cor_roles"
ZONES = "pr_priority_flora.t_zprospect"
AREAS = "pr_priority_flora.t_apresence"
OBSERVERS = "pr_priority_flora.cor_zp_obs"
DISTURBANCES = "pr_priority_flora.cor_ap_perturbation"
PHYSIOGNOMIES = "pr_priority_flora.cor_ap_physiognomy"
NOMENCLATURES = "ref_nomenclatures.t_nomenclatures"

# Fixed value: the part of a document that tells where a row came from.
ORIGIN = "migrateOriginalInfos"

# The nomenclature type behind each code of an area.
AREA_CODES = {
    "incline": "INCLINE_TYPE",
    "habitat": "HABITAT_STATUS",
    "threat_level": "THREAT_LEVEL",
    "phenology": "PHENOLOGY_TYPE",
    "frequency_method": "FREQUENCY_METHOD",
    "counting": "COUNTING_TYPE",
}

# The partner's disturbance codes and their standard codes.
DISTURBANCE_CODES = (
    ("Aval", "Aam"),
    ("AvalAp", "Aam"),
    ("Béto", "Beg"),
    ("Bois", "Bcl"),
    ("Cura", "Cur"),
    ("Elag", "Ela"),
    ("Eros", "Evs"),
    ("Pâtu", "Pat"),
    ("Piét", "Psa"),
    ("Prod", "Prp"),
    ("Sang", "San"),
    ("Sape", "Sbe"),
    ("Terr", "Ter"),
    ("Véhi", "Veh"),
)

# What a shared person takes over from the partner.
SHARED_COLUMNS = ("groupe", "uuid_role", "identifiant", "nom_role", "prenom_role", "desc_role",
                  "pass", "pass_plus", "remarques", "active")
NEW_COLUMNS = ("uuid_role", "identifiant", "nom_role", "prenom_role", "desc_role", "pass",
               "pass_plus", "email", "remarques", "active", "date_insert", "date_update")


@dataclass(frozen=True)
class Partner:
    """How a partner is named, and the tables it handed over.

    ``organism`` is its name among the organisms, ``origin`` the name that its zones carry
    in their documents, ``field`` the document field that keeps its person ids.
    """

    organism: str
    origin: str
    field: str
    users_group: str
    observers_group: str
    roles: DataFrame
    zones: DataFrame
    areas: DataFrame


def organism_by_name(organisms: DataFrame, name: str) -> Column:
    return scalar_lookup(organisms, F.col("nom_organisme") == name, "id_organisme")


def organism_by_uuid(organisms: DataFrame, uuid: str) -> Column:
    return scalar_lookup(organisms, F.col("uuid_organisme") == uuid, "id_organisme")


def group_by_name(roles: DataFrame, name: str) -> Column:
    return scalar_lookup(roles, (F.col("nom_role") == name) & F.col("groupe"), "id_role")


def zone_index(document: str = "additional_data") -> Column:
    """The zone's number in its original database, with its JSON type."""
    return json_typed(document, ORIGIN, "indexZp")


def reconcile_partner(spark: SparkSession, snapshot: Snapshot, partner: Partner) -> Snapshot:
    done = dict(snapshot)
    organism = organism_by_name(done[ORGANISMS], partner.organism)
    common = F.get_json_object("additional_data", f"$.{ORIGIN}.nomOrganisme") == partner.origin

    # Inserts write their new rows, with the ids these got. The roles before them have keys
    # computed from documents that several steps use, so they are written once.
    reference = json_nested(ORIGIN, **{partner.field: F.col("id_role")})
    taken = partner.roles.select("id_role", "email", *SHARED_COLUMNS,
                                 reference.alias("champs_addi"))
    roles = overwrite_matched(
        done[ROLES], taken, "email",
        {**{name: F.col(f"source.{name}") for name in (*SHARED_COLUMNS, "champs_addi")},
         "id_organisme": organism}, id="id_role")
    roles = link_missing_observers(
        roles, partner.roles, partner.zones,
        done[ZONES].filter(common).select(zone_index().alias("__index")),
        zone_index(), "ids_role", "nom_obs", "id_role", "prenom_role", "nom_role",
        "champs_addi", [ORIGIN], partner.field)
    roles = insert_missing(
        materialize(roles, "roles"),
        partner.roles.filter(F.col("groupe") == F.lit(False)).select(
            F.lit(False).alias("groupe"), *NEW_COLUMNS, organism.alias("id_organisme"),
            reference.alias("champs_addi")),
        "uuid_role", null_aware=True, id="id_role", order=["uuid_role"], unique=True)
    done[ROLES] = roles

    zones = insert_missing(
        done[ZONES], partner.zones.drop("id_zp", "ids_role", "nom_obs"),
        [(zone_index(), zone_index())], among=common, id="id_zp", order=["uuid_zp"],
        unique=True)
    done[ZONES] = zones

    lookups = [
        (done[NOMENCLATURES],
         [(F.lit(kind), "mnemonique_type"),
          (F.col(f"code_nomenc_{name}").cast("string"), "cd_nomenclature")],
         "id_nomenclature", f"id_nomenclature_{name}")
        for name, kind in AREA_CODES.items()]
    areas = insert_children(done[AREAS], partner.areas, partner.zones, zones, "id_zp", "uuid_zp",
                            lookups, id="id_ap", order=["uuid_ap"], unique=True)
    done[AREAS] = areas

    shared = (partner.zones.select(zone_index().alias("__index"), "nom_obs")
              .join(zones.filter(common).select(zone_index().alias("__index"), "id_zp"),
                    "__index"))
    observers = append(done[OBSERVERS], missing_links(
        shared, "id_zp", "nom_obs", done[OBSERVERS], roles, "id_role", "prenom_role", "nom_role"))
    done[OBSERVERS] = append(observers, links_from_id_list(
        partner.zones, "ids_role", "uuid_zp", zones, "uuid_zp", "id_zp", roles, "id_role",
        json_text("champs_addi", ORIGIN, partner.field)))

    arrived = areas.select("id_ap", "uuid_ap").join(
        partner.areas.select("uuid_ap", "perturbation", "physionomy"), "uuid_ap")
    mapping = values(spark, DISTURBANCE_CODES, "source_code string, standard_code string")
    done[DISTURBANCES] = append(done[DISTURBANCES], codes_to_links(
        arrived, "id_ap", "perturbation", done[NOMENCLATURES], "cd_nomenclature",
        "id_nomenclature", mapping))
    done[PHYSIOGNOMIES] = append(done[PHYSIOGNOMIES], codes_to_links(
        arrived, "id_ap", "physionomy", done[NOMENCLATURES], "cd_nomenclature",
        "id_nomenclature"))

    ours = (F.col("id_organisme") == organism) & F.col("active").eqNullSafe(True)
    password = F.coalesce("pass", "pass_plus")
    links = assign_group(roles, done[GROUPS], group_by_name(roles, partner.users_group),
                         ours & password.isNotNull(), only_ungrouped=True)
    done[GROUPS] = assign_group(roles, links, group_by_name(roles, partner.observers_group),
                                ours & password.isNull(), only_ungrouped=True)
    return done
