"""Merge duplicate people or organisms across all tables that refer to them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from reknit.operators.merge import (
    KeyMap, KeyRule, LinkRule, MergeSpec, merge_snapshot, resolve_requests, resolve_valid)
from reknit.operators.references import ForeignKey
from reknit.operators.rows import Snapshot
from reknit.session import job_scratch
from reknit.sources.publish import Published, publish
from reknit.sources.requests import merge_requests, read_merge_requests
from reknit.sources.touched import merge_touched

# The tables that refer to a person.
PEOPLE = MergeSpec(
    table="utilisateurs.t_roles",
    id="id_role",
    links=(
        LinkRule("utilisateurs.cor_roles", "id_role_utilisateur", ("id_role_groupe",)),
        LinkRule("utilisateurs.cor_role_liste", "id_role", ("id_liste",)),
        LinkRule("gn_commons.t_validations", "id_validator",
                 ("uuid_attached_row", "id_nomenclature_valid_status", "validation_auto",
                  "validation_comment", "validation_date")),
        LinkRule("gn_commons.t_places", "id_role", ("place_name", "place_geom")),
        LinkRule("gn_meta.cor_acquisition_framework_actor", "id_role",
                 ("id_acquisition_framework", "id_nomenclature_actor_role")),
        LinkRule("gn_meta.cor_dataset_actor", "id_role",
                 ("id_dataset", "id_nomenclature_actor_role")),
        LinkRule("gn_permissions.cor_role_action_filter_module_object", "id_role",
                 ("id_module", "id_action", "id_object", "id_filter")),
        LinkRule("gn_synthese.cor_observer_synthese", "id_role", ("id_synthese",)),
        LinkRule("gn_monitoring.cor_visit_observer", "id_role", ("id_base_visit",)),
        LinkRule("pr_priority_flora.cor_zp_obs", "id_role", ("id_zp",), optional=True),
    ),
    keys=(
        KeyRule("gn_meta.t_acquisition_frameworks", "id_digitizer"),
        KeyRule("gn_meta.t_datasets", "id_digitizer"),
        KeyRule("gn_synthese.synthese", "id_digitiser"),
        KeyRule("gn_monitoring.t_base_sites", "id_inventor"),
        KeyRule("gn_monitoring.t_base_sites", "id_digitiser"),
        KeyRule("gn_monitoring.t_base_visits", "id_digitiser"),
        KeyRule("pr_conservation_strategy.t_assessment", "meta_create_by", optional=True),
        KeyRule("pr_conservation_strategy.t_assessment", "meta_update_by", optional=True),
    ),
)

# The tables that refer to an organism.
ORGANISMS = MergeSpec(
    table="utilisateurs.bib_organismes",
    id="id_organisme",
    links=(
        LinkRule("gn_meta.cor_dataset_actor", "id_organism",
                 ("id_dataset", "id_nomenclature_actor_role")),
        LinkRule("gn_meta.cor_acquisition_framework_actor", "id_organism",
                 ("id_acquisition_framework", "id_nomenclature_actor_role")),
        LinkRule("pr_conservation_strategy.cor_action_organism", "id_organism", ("id_action",),
                 optional=True),
    ),
    keys=(
        KeyRule("utilisateurs.bib_organismes", "id_parent"),
        KeyRule("utilisateurs.t_roles", "id_organisme"),
        KeyRule("utilisateurs.temp_users", "id_organisme"),
        KeyRule("gn_commons.t_parameters", "id_organism"),
        KeyRule("gn_synthese.defaults_nomenclatures_value", "id_organism"),
        KeyRule("ref_nomenclatures.defaults_nomenclatures_value", "id_organism"),
    ),
)


def merge_from_file(spark: SparkSession, snapshot: Snapshot, spec: MergeSpec, path: str,
                    root: str, references: Iterable[ForeignKey] = ()) -> str:
    """Apply a request file and publish the merged snapshot; returns the version.

    Of a published snapshot only files with merged ids are written again, and the rest is shared
    with the version it was read from. With ``references`` nothing is published that would leave
    rows behind which refer to an entity merged away. Nothing stays in the scratch folder.
    """
    with job_scratch(spark):
        keymap = resolve_requests(read_merge_requests(spark, path))
        return _publish(spark, snapshot, spec, keymap, root, references)


def merge_from_arguments(spark: SparkSession, snapshot: Snapshot, spec: MergeSpec,
                         pairs: Iterable[tuple[int, str]], root: str,
                         references: Iterable[ForeignKey] = ()) -> str:
    """The same for (survivor, comma list of old ids) pairs."""
    with job_scratch(spark):
        keymap = resolve_requests(merge_requests(spark, pairs))
        return _publish(spark, snapshot, spec, keymap, root, references)


def merge_what_can_be(spark: SparkSession, snapshot: Snapshot, spec: MergeSpec,
                      requests: DataFrame, root: str, refused_to: str,
                      references: Iterable[ForeignKey] = ()) -> str:
    """Apply the requests that can be applied, and write the others, with reasons, to a folder."""
    with job_scratch(spark):
        keymap, refused = resolve_valid(requests)
        refused.write.parquet(refused_to)
        return _publish(spark, snapshot, spec, keymap, root, references)


def _publish(spark: SparkSession, snapshot: Snapshot, spec: MergeSpec, keymap: KeyMap, root: str,
             references: Iterable[ForeignKey]) -> str:
    if isinstance(snapshot, Published) and snapshot.root == root.rstrip("/"):
        merged, rewrites = merge_touched(snapshot, spec, keymap)
    else:
        merged, rewrites = merge_snapshot(snapshot, spec, keymap), {}
    # What a merge leaves alone may still decide what it drops.
    reads = [rule.table for rule in [*spec.keys, *spec.links]] + [spec.table]
    return publish(spark, merged, root, snapshot, rewrites, references=references, reads=reads)
