"""Plots with parents, and temperature sensors read from site descriptions."""

from __future__ import annotations

from reknit.operators.extract import SENSOR_GUARD, extract_facts, sensor_facts
from reknit.operators.hierarchy import derive_parents, link_parents
from reknit.operators.keys import allocate_ids
from reknit.operators.rows import Snapshot, append
from reknit.session import materialize

PLOTS = "pr_monitoring_habitat_station.t_plots"
TRANSECTS = "pr_monitoring_habitat_station.t_transects"
SENSORS = "pr_monitoring_habitat_station.t_temperature_sensors"
SITES = "gn_monitoring.t_base_sites"
ID = "id_sensor"


def migrate_plots(snapshot: Snapshot) -> Snapshot:
    shape = dict(id="id_plot", code="code_plot", by=["id_transect"], moved="distance_plot",
                 parent="id_parent")
    with_parents = materialize(derive_parents(snapshot[PLOTS], **shape), "plots")
    return {**snapshot, PLOTS: link_parents(with_parents, **shape)}


def migrate_temperature_sensors(snapshot: Snapshot, strict: bool = True) -> Snapshot:
    """Add a sensor per transect whose site describes one; ``strict`` raises on a false date.

    Where the target has ids, new sensors get the next ones, by transect.
    """
    described = extract_facts(
        snapshot[SITES].select("id_base_site", "base_site_description"),
        "base_site_description", SENSOR_GUARD, sensor_facts("base_site_description", strict))
    found = snapshot[TRANSECTS].select("id_transect", "id_base_site").join(
        described, "id_base_site").select("id_transect", "serial_number", "install_date")
    if ID in snapshot[SENSORS].columns:
        found = allocate_ids(found, snapshot[SENSORS], ID, found.columns)
    return {**snapshot, SENSORS: append(snapshot[SENSORS], found)}
