"""Seed an acquisition framework with its datasets, actors and modules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.rows import Snapshot, set_where
from reknit.operators.seed import Reference, Seed, seed_metadata

FRAMEWORKS = "gn_meta.t_acquisition_frameworks"
DATASETS = "gn_meta.t_datasets"
NOMENCLATURES = "ref_nomenclatures.t_nomenclatures"
ORGANISMS = "utilisateurs.bib_organismes"
MODULES = "gn_commons.t_modules"

# The id columns filled from a nomenclature type and a code.
FRAMEWORK_CODES = {
    "id_nomenclature_territorial_level": "NIVEAU_TERRITORIAL",
    "id_nomenclature_financing_type": "TYPE_FINANCEMENT",
}
DATASET_CODES = {
    "id_nomenclature_data_type": "DATA_TYP",
    "id_nomenclature_dataset_objectif": "JDD_OBJECTIFS",
    "id_nomenclature_collecting_method": "METHO_RECUEIL",
    "id_nomenclature_data_origin": "DS_PUBLIQUE",
    "id_nomenclature_source_status": "STATUT_SOURCE",
    "id_nomenclature_resource_type": "RESOURCE_TYP",
}
ACTOR_CODES = {"id_nomenclature_actor_role": "ROLE_ACTEUR"}
OBJECTIVE_CODES = {"id_nomenclature_objectif": "CA_OBJECTIFS"}
SECTION_CODES = {"id_nomenclature_voletsinp": "VOLET_SINP"}


def nomenclature(columns: Mapping[str, str]) -> list[Reference]:
    """References that find each column by its type and the code in ``<column>_code``."""
    return [Reference(column, NOMENCLATURES,
                      [(F.lit(kind), "mnemonique_type"), (f"{column}_code", "cd_nomenclature")],
                      "id_nomenclature")
            for column, kind in columns.items()]


FRAMEWORK = Reference("id_acquisition_framework", FRAMEWORKS,
                      [("framework_uuid", "unique_acquisition_framework_id")],
                      "id_acquisition_framework")
DATASET = Reference("id_dataset", DATASETS, [("dataset_uuid", "unique_dataset_id")], "id_dataset")
ORGANISM = Reference("id_organism", ORGANISMS, [("organism_name", "nom_organisme")],
                     "id_organisme")


def module() -> Reference:
    """The module of a code, whatever its case."""
    code = F.lower("module_code")
    return Reference("id_module", MODULES, [(code, code)], "id_module")


def relabel_modules(modules: DataFrame, texts: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Set columns of the modules with the given codes, whatever their case."""
    for code, fields in texts.items():
        modules = set_where(modules, F.col("module_code").ilike(code),
                            {name: F.lit(value) for name, value in fields.items()})
    return modules


def seed_datasets(snapshot: Snapshot, rows: Mapping[str, DataFrame], strict: bool = True
                  ) -> Snapshot:
    """Add the rows, given with codes, names and UUIDs instead of ids.

    ``rows`` may have: frameworks, framework_actors, framework_objectives,
    framework_sections, datasets, dataset_actors, dataset_modules. A name that is given and
    not found is an error, unless ``strict`` is off: then its id is NULL.
    """
    steps = (
        ("frameworks", FRAMEWORKS, nomenclature(FRAMEWORK_CODES), "id_acquisition_framework"),
        ("framework_actors", "gn_meta.cor_acquisition_framework_actor",
         [FRAMEWORK, ORGANISM, *nomenclature(ACTOR_CODES)], None),
        ("framework_objectives", "gn_meta.cor_acquisition_framework_objectif",
         [FRAMEWORK, *nomenclature(OBJECTIVE_CODES)], None),
        ("framework_sections", "gn_meta.cor_acquisition_framework_voletsinp",
         [FRAMEWORK, *nomenclature(SECTION_CODES)], None),
        ("datasets", DATASETS, [FRAMEWORK, *nomenclature(DATASET_CODES)], "id_dataset"),
        ("dataset_actors", "gn_meta.cor_dataset_actor",
         [DATASET, ORGANISM, *nomenclature(ACTOR_CODES)], None),
        ("dataset_modules", "gn_commons.cor_module_dataset", [module(), DATASET], None),
    )
    return seed_metadata(snapshot, [
        Seed(table, rows[name], references, id)
        for name, table, references, id in steps if name in rows], strict)
