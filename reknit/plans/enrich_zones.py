"""Store a project's zonings and management actions in the documents of zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.documents import enrich_json
from reknit.operators.rows import Snapshot

ZONES = "pr_priority_flora.t_zprospect"
ORIGIN = "migrateOriginalInfos"


def _labelled(links: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    return links.join(labels.select(key, "libelle"), key).select("indexzp", key, "libelle")


def enrich_zones(snapshot: Snapshot, project: Snapshot, project_field: str,
                 strict_null: bool = False) -> Snapshot:
    """Set {migrateOriginalInfos, project_field} to the zonings, then add the actions.

    Zonings replace what was stored there before, actions join it.
    """
    index = F.get_json_object("additional_data", f"$.{ORIGIN}.indexZp").cast("long")
    path = [ORIGIN, project_field]
    zones = enrich_json(
        snapshot[ZONES], _labelled(project["zonages_zp"], project["zonages"], "idzonage"),
        "indexzp", "idzonage", "libelle", index, "additional_data", path, "zonages")
    zones = enrich_json(
        zones, _labelled(project["types_actions_gestion_zp"], project["types_actions_gestion"],
                         "idtypeaction"),
        "indexzp", "idtypeaction", "libelle", index, "additional_data", path, "actionsGestion",
        merge=True, strict_null=strict_null)
    return {**snapshot, ZONES: zones}
