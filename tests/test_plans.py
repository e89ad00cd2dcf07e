"""The whole jobs on small invented snapshots."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reknit.operators.quality import check_unique
from reknit.plans import (
    enrich_zones, habitat_stations, merge_entities, migrate_users, reconcile_partner,
    seed_datasets, taxon_lists)
from reknit.plans.migrate_users import Rights, Texts
from reknit.operators.merge import apply_merges
from reknit.sources.publish import publish, published_versions, read_published
from reknit.sources.requests import merge_requests
from reknit.sources.tables import read_diff_csv, read_import_batch, read_tables

ORIGIN = "migrateOriginalInfos"


def empty(frame, spec):
    """An empty table per column list of a merge spec."""
    columns = {}
    for rule in spec.links:
        columns.setdefault(rule.table, set()).update({rule.key, *rule.compare})
    for rule in spec.keys:
        columns.setdefault(rule.table, set()).add(rule.key)
    columns.setdefault(spec.table, set()).add(spec.id)
    return {table: frame(", ".join(f"{name} long" for name in sorted(names)))
            for table, names in columns.items()}


def test_merge_people_covers_all_tables(spark, frame, rows):
    snapshot = empty(frame, merge_entities.PEOPLE)
    del snapshot["pr_conservation_strategy.t_assessment"]
    snapshot["utilisateurs.t_roles"] = frame("id_role long, n string", (1, "a"), (2, "b"), (3, "c"))
    snapshot["utilisateurs.cor_roles"] = frame(
        "id_role_groupe long, id_role_utilisateur long", (7, 1), (7, 2), (8, 2), (8, 3))
    snapshot["gn_monitoring.t_base_sites"] = frame(
        "id_inventor long, id_digitiser long", (2, 3), (1, 2), (None, 2))
    snapshot["gn_commons.t_validations"] = frame(
        "id_validator long, uuid_attached_row string, id_nomenclature_valid_status long, "
        "validation_auto boolean, validation_comment string, validation_date timestamp",
        (1, "u", 1, True, None, datetime(2020, 1, 1)), (2, "u", 1, True, None, datetime(2020, 1, 1)),
        (1, "v", 1, True, "c", datetime(2020, 1, 1)), (2, "v", 1, True, "c", datetime(2020, 1, 1)))
    snapshot["gn_commons.t_places"] = frame(
        "id_role long, place_name string, place_geom binary", (1, "p", b"\x01"), (2, "p", b"\x01"),
        (2, "p", b"\x02"))
    merged = apply_merges(snapshot, merge_entities.PEOPLE,
                                         merge_requests(spark, [(1, "2")]))
    assert rows(merged["utilisateurs.t_roles"]) == [(1, "a"), (3, "c")]
    assert rows(merged["utilisateurs.cor_roles"]) == [(7, 1), (8, 1), (8, 3)]
    assert rows(merged["gn_monitoring.t_base_sites"]) == sorted(
        [(1, 3), (1, 1), (None, 1)], key=repr)
    assert rows(merged["gn_commons.t_validations"], "id_validator", "uuid_attached_row") == [
        (1, "u"), (1, "u"), (1, "v")]
    assert rows(merged["gn_commons.t_places"], "id_role", "place_geom") == [
        (1, bytearray(b"\x01")), (1, bytearray(b"\x02"))]


def test_merge_organisms_from_file(spark, frame, rows, tmp_path):
    snapshot = empty(frame, merge_entities.ORGANISMS)
    snapshot["utilisateurs.bib_organismes"] = frame(
        "id_organisme long, id_parent long", (1, 2), (2, None), (3, 2))
    snapshot["utilisateurs.t_roles"] = frame("id_role long, id_organisme long", (1, 2), (2, None))
    requests = tmp_path / "requests.tsv"
    requests.write_text("id\tid_duplicates\n1\t2\n")
    root = str(tmp_path / "data")
    merge_entities.merge_from_file(spark, snapshot, merge_entities.ORGANISMS, str(requests), root)
    merged = read_published(spark, root)
    assert rows(merged["utilisateurs.bib_organismes"]) == [(1, 1), (3, 1)]
    assert rows(merged["utilisateurs.t_roles"]) == sorted([(1, 1), (2, None)], key=repr)


def test_invalid_requests_publish_nothing(spark, frame, tmp_path):
    requests = tmp_path / "requests.tsv"
    requests.write_text("id\tid_duplicates\n1\t1\n")
    with pytest.raises(ValueError, match="itself"):
        merge_entities.merge_from_file(spark, empty(frame, merge_entities.PEOPLE),
                                       merge_entities.PEOPLE, str(requests), str(tmp_path / "d"))
    assert published_versions(spark, str(tmp_path / "d")) == []


ORGANISM = ", ".join(f"{name}_organisme string"
                     for name in ("nom", "adresse", "cp", "ville", "tel", "fax", "email"))
ROLE = ("id_role long, groupe boolean, identifiant string, nom_role string, prenom_role string, "
        "desc_role string, pass string, email string, id_organisme long")


def test_migrate_users(spark, frame, rows):
    stamps = (datetime(2020, 1, 1), None, None)
    source = {
        "bib_organismes": frame(
            f"id_organisme long, {ORGANISM}",
            (1, "Alpha", "", "", "Gap", " 04.92.00.00.01", "0492000002", "www.alpha.example"),
            (2, "Beta", "x", "05", "", "", None, "b@example.org"),
            (3, "Unused", "", "", "", "", "", "")),
        "t_roles": frame(
            f"{ROLE}, date_insert timestamp, date_update timestamp, dernieracces timestamp",
            (10000, True, "g1", "users", None, None, None, None, None, *stamps),
            (10001, True, "g2", "observers", None, None, None, None, None, *stamps),
            (5, False, "", "roy", "Zoé", "", "secret", "z@example.org", 1, *stamps),
            (6, False, "b", "Blanc", "", None, "", "", 2, *stamps),
            (7, False, "c", "Out", "Side", None, "x", None, 3, *stamps)),
        "cor_roles": frame("id_role_groupe long, id_role_utilisateur long",
                           (10000, 5), (10001, 5), (10001, 6), (9, 7)),
    }
    snapshot = {
        migrate_users.ORGANISMS: frame(
            f"id_organisme long, {ORGANISM}, url_organisme string",
            (0, "None", None, None, None, None, None, None, None),
            (99, "Old", None, None, None, None, None, None, None)),
        migrate_users.ROLES: frame(
            f"{ROLE}, uuid_role string, pass_plus string, remarques string, active boolean, "
            "champs_addi string",
            (1, False, "a", "gone", "x", None, None, None, None, "u", None, None, True, None)),
        migrate_users.GROUPS: frame("id_role_groupe long, id_role_utilisateur long", (1, 1)),
        migrate_users.LISTS: frame(
            "id_liste long, code_liste string, nom_liste string, desc_liste string"),
        migrate_users.LIST_ROLES: frame("id_role long, id_liste long"),
        migrate_users.APPLICATIONS: frame(
            "id_application long, code_application string, nom_application string, "
            "desc_application string"),
        migrate_users.APPLICATION_ROLES: frame(
            "id_role long, id_application long, id_profil long"),
        migrate_users.APPLICATION_PROFILES: frame("id_profil long, id_application long"),
        migrate_users.RIGHTS: frame(
            "id_role long, id_action long, id_filter long, id_module long, id_object long"),
        migrate_users.MODULES: frame("id_module long, module_code string", (42, "SFT")),
        "gn_synthese.synthese": frame("id_synthese long", (1,)),
        "gn_synthese.cor_area_synthese": frame("id_synthese long", (1,)),
    }
    texts = Texts(
        remark="Imported.", list_row=(1, "L", "List", "A list."),
        group_names={10000: ("Users", "group_users", "May write.")},
        applications=[(1, "UH", "Hub", ""), (2, "TH", "Taxa", ""), (3, "GN", "Nature", "")],
        admin_group=(10, "group_admin", "Administrators", "All rights."),
        admins=[5], organism_names={2: "BETA PARK"}, url_in_email=[1])
    rights = Rights(
        group_profiles=[(10, "UH", 6), (10, "TH", 6), (10, "GN", 6), (10000, "GN", 2)],
        profiles=[(6, "UH"), (1, "GN")],
        scopes=[(10, 1, 4, 0, None, 1), *[(10000, action, scope, None, "SFT", 1) for action, scope
                                          in enumerate((4, 4, 3, 1, 4, 2), start=1)]])
    done = migrate_users.migrate_users(spark, snapshot, source, texts, rights)
    doubled = {**source, "t_roles": source["t_roles"].unionByName(
        source["t_roles"].filter("id_role = 5").withColumn("id_role", F.lit(6).cast("long")))}
    with pytest.raises(ValueError, match="email repeat"):
        migrate_users.migrate_users(spark, snapshot, doubled, texts, rights)

    assert rows(done[migrate_users.ORGANISMS], "id_organisme", "nom_organisme", "ville_organisme",
                "tel_organisme", "fax_organisme", "email_organisme", "url_organisme") == [
        (0, "None", None, None, None, None, None),
        (1, "Alpha", "GAP", "04 92 00 00 01", "04 92 00 00 02", None, "www.alpha.example"),
        (2, "BETA PARK", None, None, None, "b@example.org", None)]
    roles = done[migrate_users.ROLES]
    assert rows(roles, "id_role", "nom_role", "prenom_role", "pass", "remarques") == sorted([
        (10, "Administrators", None, None, "All rights."),
        (5, "ROY", "Zoé", "secret", "Imported."), (6, "BLANC", None, None, "Imported."),
        (10000, "Users", None, None, "Imported."),
        (10001, "OBSERVERS", None, None, "Imported.")], key=repr)
    assert rows(roles.filter("id_role = 5"), "champs_addi") == [(
        '{"migrateOriginalInfos":{"dateInsert":"2020-01-01T00:00:00","dateUpdate":null,'
        '"lastAccess":null,"roleId":5,"organismId":1,"organismName":"Alpha"}}',)]
    assert roles.filter("uuid_role IS NULL").count() == 1  # the added group of administrators
    assert rows(done[migrate_users.GROUPS]) == [(10, 5), (10000, 5), (10001, 6)]
    assert rows(done[migrate_users.LIST_ROLES]) == [(10000, 1), (10001, 1)]
    assert rows(done[migrate_users.APPLICATION_ROLES]) == [
        (10, 1, 6), (10, 2, 6), (10, 3, 6), (10000, 3, 2)]
    rights = done[migrate_users.RIGHTS]
    assert rights.count() == 7
    assert rows(rights.filter("id_module = 42"), "id_action", "id_filter") == [
        (1, 4), (2, 4), (3, 3), (4, 1), (5, 4), (6, 2)]
    assert done["gn_synthese.cor_area_synthese"].count() == 0


def test_seed_datasets(frame, rows):
    nomenclatures = frame(
        "id_nomenclature long, mnemonique_type string, cd_nomenclature string",
        (1, "NIVEAU_TERRITORIAL", "4"), (2, "TYPE_FINANCEMENT", "1"), (3, "ROLE_ACTEUR", "1"),
        (4, "DATA_TYP", "1"), (5, "DATA_TYP", "4"))
    snapshot = {
        seed_datasets.NOMENCLATURES: nomenclatures,
        seed_datasets.ORGANISMS: frame("id_organisme long, nom_organisme string", (8, "Alpha")),
        seed_datasets.MODULES: frame("id_module long, module_code string, module_label string",
                                     (3, "sft", "old")),
        seed_datasets.FRAMEWORKS: frame(
            "id_acquisition_framework long, unique_acquisition_framework_id string, "
            "acquisition_framework_name string, id_nomenclature_territorial_level long, "
            "id_nomenclature_financing_type long", (6, "f0", "Earlier", None, None)),
        seed_datasets.DATASETS: frame(
            "id_dataset long, unique_dataset_id string, id_acquisition_framework long, "
            "id_nomenclature_data_type long, id_nomenclature_dataset_objectif long, "
            "id_nomenclature_collecting_method long, id_nomenclature_data_origin long, "
            "id_nomenclature_source_status long, id_nomenclature_resource_type long"),
        "gn_meta.cor_dataset_actor": frame(
            "id_dataset long, id_role long, id_organism long, id_nomenclature_actor_role long"),
        "gn_commons.cor_module_dataset": frame("id_module long, id_dataset long"),
    }
    codes = ", ".join(f"{name}_code string" for name in seed_datasets.DATASET_CODES)
    seeds = {
        "frameworks": frame(
            "unique_acquisition_framework_id string, acquisition_framework_name string, "
            "id_nomenclature_territorial_level_code string, "
            "id_nomenclature_financing_type_code string", ("f1", "Surveys", "4", "1")),
        "datasets": frame(f"unique_dataset_id string, framework_uuid string, {codes}",
                          ("d1", "f1", "1", None, None, None, None, None),
                          ("d2", "nowhere", "9", None, None, None, None, None)),
        "dataset_actors": frame(
            "dataset_uuid string, organism_name string, id_nomenclature_actor_role_code string",
            ("d1", "Alpha", "1"), ("d2", "Renamed", "1")),
        "dataset_modules": frame("module_code string, dataset_uuid string", ("SFT", "d1")),
    }
    with pytest.raises(ValueError, match="no id_acquisition_framework for"):
        seed_datasets.seed_datasets(snapshot, seeds)
    done = seed_datasets.seed_datasets(snapshot, seeds, strict=False)
    assert rows(done[seed_datasets.FRAMEWORKS].filter("id_acquisition_framework > 6")) == [
        (7, "f1", "Surveys", 1, 2)]
    assert rows(done[seed_datasets.DATASETS], "id_dataset", "id_acquisition_framework",
                "id_nomenclature_data_type") == sorted([(1, 7, 4), (2, None, None)], key=repr)
    assert rows(done["gn_meta.cor_dataset_actor"]) == sorted(
        [(1, None, 8, 3), (2, None, None, 3)], key=repr)
    assert rows(done["gn_commons.cor_module_dataset"]) == [(3, 1)]
    labelled = seed_datasets.relabel_modules(
        snapshot[seed_datasets.MODULES], {"SFT": {"module_label": "Survey"}})
    assert rows(labelled) == [(3, "sft", "Survey")]


def zone(index, organism="Park"):
    return f'{{"{ORIGIN}":{{"indexZp":{index},"nomOrganisme":"{organism}"}}}}'


def partner_zone(index):
    return f'{{"{ORIGIN}":{{"indexZp":{index}}}}}'


def test_reconcile_partner(spark, frame, rows):
    role = ("id_role long, uuid_role string, groupe boolean, identifiant string, nom_role string, "
            "prenom_role string, desc_role string, pass string, pass_plus string, email string, "
            "id_organisme long, remarques string, active boolean, champs_addi string, "
            "date_insert timestamp, date_update timestamp")

    def person(id, uuid, last, first, mail=None, password=None, group=False, organism=None,
               doc=None, active=True):
        return (id, uuid, group, None, last, first, None, password, None, mail, organism, None,
                active, doc, None, None)

    zones = ("uuid_zp string, cd_nom long, date_min date, date_max date, geom_4326 binary, "
             "initial_insert string, topo_valid boolean, additional_data string, "
             "meta_create_date timestamp, meta_update_date timestamp, id_zp long")
    plain = (1, None, None, b"\x01", None, True)
    area_values = ("geom_4326 binary, area double, favorable_status_percent double, "
                   "frequency double, comment string")
    codes = [f"code_nomenc_{name} long" for name in reconcile_partner.AREA_CODES]
    ids = [f"id_nomenclature_{name} long" for name in reconcile_partner.AREA_CODES]
    snapshot = {
        reconcile_partner.ORGANISMS: frame(
            "id_organisme long, nom_organisme string, uuid_organisme string", (4, "PARK", "o4")),
        reconcile_partner.ROLES: frame(
            role,
            person(1, "r1", "Roy", "Zoé", mail="zoe@example.org"),
            person(2, "r2", "Martin (stagiaire)", "Léo", doc='{"note":1}'),
            person(3, "r3", "Petit", "Ana", mail="ana@example.org"),
            person(90, "g1", "Users", None, group=True),
            person(91, "g2", "Observers", None, group=True)),
        reconcile_partner.GROUPS: frame("id_role_groupe long, id_role_utilisateur long", (90, 3)),
        reconcile_partner.ZONES: frame(
            zones, ("z1", *plain, zone(11), None, None, 100),
            ("z9", *plain, zone(12, "Other"), None, None, 101)),
        reconcile_partner.AREAS: frame(
            f"id_ap long, uuid_ap string, id_zp long, {area_values}, {', '.join(ids)}"),
        reconcile_partner.OBSERVERS: frame("id_zp long, id_role long", (100, 1)),
        reconcile_partner.DISTURBANCES: frame("id_ap long, id_nomenclature long"),
        reconcile_partner.PHYSIOGNOMIES: frame("id_ap long, id_nomenclature long"),
        reconcile_partner.NOMENCLATURES: frame(
            "id_nomenclature long, mnemonique_type string, cd_nomenclature string",
            (1, "INCLINE_TYPE", "2"), (2, "HABITAT_STATUS", "2"), (3, "X", "Beg"), (4, "X", "Cur"),
            (5, "Y", "Cur")),
    }
    lists = "ids_role string, nom_obs string"
    partner = reconcile_partner.Partner(
        "PARK", "Park", "idPartner", "Users", "Observers",
        roles=frame(role, person(501, "p1", "Roy", "Zoe", mail="zoe@example.org", password="x"),
                    person(502, "p2", "Neuf", "Eve"), person(503, "p3", "Club", None, group=True)),
        zones=frame(f"{zones}, {lists}",
                    ("z1b", *plain, partner_zone(11), None, None, 71, "501,777", "Zoé Roy, Ana Petit"),
                    ("z2", *plain, partner_zone(12), None, None, 72, "501, 778", "Zoé Roy, Léo Martin")),
        areas=frame(f"uuid_ap string, id_zp long, {area_values}, perturbation string, "
                    f"physionomy string, {', '.join(codes)}",
                    ("a1", 72, b"\x02", 1.5, 10.0, None, "c", "Béto, Cur", "Cur,Cur", 2, 2, None,
                     None, None, None),
                    ("a2", 71, None, None, None, None, None, "Beg", None, *[None] * 6)))
    done = reconcile_partner.reconcile_partner(spark, snapshot, partner)

    roles = done[reconcile_partner.ROLES]
    assert rows(roles, "id_role", "uuid_role", "id_organisme", "champs_addi") == sorted([
        (1, "p1", 4, f'{{"{ORIGIN}":{{"idPartner":501}}}}'),
        (2, "r2", None, f'{{"{ORIGIN}":{{"idPartner":778}},"note":1}}'),
        (3, "r3", None, None), (90, "g1", None, None), (91, "g2", None, None),
        (92, "p2", 4, f'{{"{ORIGIN}":{{"idPartner":502}}}}')], key=repr)
    assert rows(done[reconcile_partner.ZONES], "id_zp", "uuid_zp") == [
        (100, "z1"), (101, "z9"), (102, "z2")]
    areas = done[reconcile_partner.AREAS]
    assert rows(areas, "id_ap", "uuid_ap", "id_zp", "id_nomenclature_incline",
                "id_nomenclature_habitat", "id_nomenclature_counting") == [
        (1, "a1", 102, 1, 2, None)]
    # Common zone: Ana was listed but not linked. New zone: partner ids 501 and 778.
    assert rows(done[reconcile_partner.OBSERVERS]) == [(100, 1), (100, 3), (102, 1), (102, 2)]
    assert rows(done[reconcile_partner.DISTURBANCES]) == [(1, 3), (1, 4), (1, 5)]
    assert rows(done[reconcile_partner.PHYSIOGNOMIES]) == [(1, 4), (1, 5)]
    assert rows(done[reconcile_partner.GROUPS]) == [(90, 1), (90, 3), (91, 92)]

    organisms = snapshot[reconcile_partner.ORGANISMS]
    assert organisms.select(reconcile_partner.organism_by_uuid(organisms, "o4")).first()[0] == 4


def test_enrich_zones(frame, rows):
    project = {
        "zonages_zp": frame("indexzp long, idzonage long", (5, 2), (5, 1), (7, 1)),
        "zonages": frame("idzonage long, libelle string", (1, "Park"), (2, "Reserve")),
        "types_actions_gestion_zp": frame("indexzp long, idtypeaction long", (5, 9), (6, 9)),
        "types_actions_gestion": frame("idtypeaction long, libelle string", (9, "Mowing")),
    }
    snapshot = {enrich_zones.ZONES: frame(
        "id_zp long, additional_data string", (1, zone(5)), (2, zone(6)), (3, None))}
    path = f'"indexZp":%d,"nomOrganisme":"Park","project":'
    done = enrich_zones.enrich_zones(snapshot, project, "project")[enrich_zones.ZONES]
    assert rows(done) == [
        (1, f'{{"{ORIGIN}":{{{path % 5}{{"actionsGestion":[{{"9":"Mowing"}}],'
            f'"zonages":[{{"1":"Park"}},{{"2":"Reserve"}}]}}}}}}'),
        (2, f'{{"{ORIGIN}":{{{path % 6}{{"actionsGestion":[{{"9":"Mowing"}}]}}}}}}'), (3, None)]
    strict = enrich_zones.enrich_zones(snapshot, project, "project", strict_null=True)
    assert rows(strict[enrich_zones.ZONES])[1] == (2, None)


def test_taxon_lists(frame, rows):
    snapshot = {
        taxon_lists.TAXREF: frame(
            "cd_nom long, cd_ref long, nom_vern string, regne string",
            (10, 10, "oak", "Plantae"), (11, 10, "chêne", "Plantae"), (20, 20, "fox", "Animalia"),
            (30, 30, "moss", "Plantae")),
        taxon_lists.NAMES: frame(
            "id_nom long, cd_nom long, cd_ref long, nom_francais string, comments string",
            (1, 30, 30, None, "here")),
        taxon_lists.LISTS: frame(
            "id_liste long, code_liste string, nom_liste string", (5, "PRIORITY_FLORA", "p")),
        taxon_lists.LIST_NAMES: frame("id_liste long, id_nom long"),
        taxon_lists.PRIORITIES: frame("cd_nom long", (11,), (11,), (30,), (99,)),
    }
    done = taxon_lists.add_priority_taxa(snapshot, "marked")
    assert rows(done[taxon_lists.NAMES]) == [
        (1, 30, 30, None, "here"), (2, 11, 10, "chêne", "marked")]
    assert rows(done[taxon_lists.LIST_NAMES]) == [(5, 2)]
    row = frame("code_liste string, nom_liste string", ("PLANTAE", "plants"))
    once = taxon_lists.add_kingdom_list(done, row, "PLANTAE", "Plantae", date(2024, 5, 6))
    assert rows(once[taxon_lists.NAMES].filter("id_nom > 2"), "id_nom", "cd_nom", "comments") == [
        (3, 10, "Added for PLANTAE list - 2024-05-06")]
    assert rows(once[taxon_lists.LIST_NAMES]) == [(5, 2), (6, 1), (6, 2), (6, 3)]
    again = taxon_lists.add_kingdom_list(once, row, "PLANTAE", "Plantae", date(2024, 5, 7))
    for table in (taxon_lists.NAMES, taxon_lists.LISTS, taxon_lists.LIST_NAMES):
        assert rows(again[table]) == rows(once[table])


def test_habitat_stations(frame, rows):
    snapshot = {
        habitat_stations.PLOTS: frame(
            "id_plot long, id_transect long, code_plot string, distance_plot double, "
            "id_parent long", (1, 1, "A.1", 5.0, None), (2, 1, "A.2", 5.0, None)),
        habitat_stations.TRANSECTS: frame("id_transect long, id_base_site long", (1, 8), (2, 8)),
        habitat_stations.SENSORS: frame(
            "id_sensor long, id_transect long, serial_number string, install_date date"),
        habitat_stations.SITES: frame(
            "id_base_site long, base_site_description string",
            (8, "Capteur temperature n°S1 (2020/01/02)"), (9, None)),
    }
    plots = habitat_stations.migrate_plots(snapshot)[habitat_stations.PLOTS]
    assert rows(plots) == [(1, 1, "A.1", None, 3), (2, 1, "A.2", None, 3), (3, 1, "A", 5.0, None)]
    sensors = habitat_stations.migrate_temperature_sensors(snapshot)[habitat_stations.SENSORS]
    assert rows(sensors, "id_sensor", "id_transect", "serial_number", "install_date") == [
        (1, 1, "S1", date(2020, 1, 2)), (2, 2, "S1", date(2020, 1, 2))]


def test_publish_is_all_or_nothing(spark, frame, rows, tmp_path):
    root = str(tmp_path / "root")
    good = frame("x long", (1,))
    first = publish(spark, {"a": good}, root)
    bad = frame("x string", ("no number",)).selectExpr("CAST(x AS long) AS x")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish(spark, {"a": good, "b": bad}, root)
    assert published_versions(spark, root) == [first]
    assert rows(read_published(spark, root)["a"]) == [(1,)]
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, "never")


def test_files(spark, rows, tmp_path):
    diff = tmp_path / "diff.csv"
    diff.write_text('"a";"b";"n"\n1;2;Zoé Roy, Ana Petit\n', encoding="utf-8")
    assert rows(read_diff_csv(spark, str(diff), "a long, b long, n string")) == [
        (1, 2, "Zoé Roy, Ana Petit")]
    (tmp_path / "07").mkdir()
    (tmp_path / "07" / "visits.csv").write_text("idzp,taxon\n4,oak\n")
    batch = read_import_batch(spark, str(tmp_path), "visits", "idzp long, taxon string", "07",
                              date(2020, 6, 1), {"idzp": "site_code", "taxon": "site_desc"})
    assert batch.columns == ["site_code", "site_desc", "import_number", "import_date"]
    assert rows(batch) == [(4, "oak", "07", date(2020, 6, 1))]
    (tmp_path / "zonages.csv").write_text("idzonage,libelle\n1,Park\n")
    tables = read_tables(spark, str(tmp_path), ["zonages"], "csv",
                         {"zonages": "idzonage long, libelle string"})
    assert rows(tables["zonages"]) == [(1, "Park")]


def test_unique_mail(frame, rows):
    roles = frame("email string, identifiant string", (None, "a"), (None, "a"), ("x", None))
    assert rows(check_unique(roles, ["email"])) == []
    assert rows(check_unique(roles, ["identifiant"])) == [("a", 2)]
