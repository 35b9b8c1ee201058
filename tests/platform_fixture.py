"""Two small tenants with overlapping ids."""

from datetime import date, datetime

from lumenpath.sources import Platform


def d(text):
    return datetime.fromisoformat(text)


TABLES = {
    "users": (
        "user_id bigint, tenant_id string, full_name string, email string, login string, is_active boolean, is_default boolean, "
        "deleted_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz, created_by string, updated_by string",
        [
            (1, "t1", "Ana", "ana@x", "ana", True, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (2, "t1", "Bea", None, "bea", False, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (3, "t1", "Default", "d@x", "def", True, True, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (4, "t1", "Gone", "g@x", "gone", True, False, d("2021-01-01"), d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (5, "t1", "Éva Manager", "e@x", "eva", True, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (6, "t1", "Loner", "l@x", "loner", True, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (9, "t1", "Admin", "a@x", "admin", True, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (1, "t2", "Other Ana", "o@x", "oana", True, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
            (9, "t2", "Other Admin", "p@x", "oadmin", True, False, None, d("2020-01-01"), d("2020-01-02"), "9", "9"),
        ],
    ),
    "groups": (
        "group_id bigint, tenant_id string, parent_group_id bigint, name string, is_active boolean",
        [
            (10, "t1", None, "Root", True), (11, "t1", 10, "Child", True), (12, "t1", 11, "Leaf", True), (13, "t1", None, "Off", False),
            (14, "t1", 13, "Under off", True), (10, "t2", None, "Root two", True),
        ],
    ),
    "group_members": (
        "user_id bigint, group_id bigint, tenant_id string",
        [(1, 10, "t1"), (1, 12, "t1"), (2, 11, "t1"), (5, 14, "t1"), (9, 11, "t1"), (3, 10, "t1"), (1, 10, "t2"), (9, 10, "t2")],
    ),
    "group_tree": (
        "root_id bigint, group_id bigint, parent_id bigint, hops bigint, tenant_id string",
        [
            (10, 10, None, 0, "t1"), (11, 11, 10, 0, "t1"), (10, 11, 10, 1, "t1"), (12, 12, 11, 0, "t1"), (11, 12, 11, 1, "t1"),
            (10, 12, 11, 2, "t1"), (14, 14, 13, 0, "t1"), (10, 10, None, 0, "t2"),
        ],
    ),
    "environments": (
        "environment_id bigint, tenant_id string, name string, is_available boolean",
        [(100, "t1", "Env", True), (101, "t1", "Bare", True), (100, "t2", "Env two", True)],
    ),
    "environment_groups": (
        "environment_id bigint, group_id bigint, tenant_id string",
        [(100, 10, "t1"), (100, 11, "t1"), (100, 12, "t1"), (100, 14, "t1"), (101, 13, "t1"), (100, 10, "t2")],
    ),
    "environment_tracks": ("environment_id bigint, track_id bigint, tenant_id string", [(100, 200, "t1"), (100, 200, "t2")]),
    "tracks": (
        "track_id bigint, tenant_id string, name string, is_active boolean, is_visible boolean",
        [(200, "t1", "Track", True, True), (200, "t2", "Track two", True, True)],
    ),
    "modules": (
        "module_id bigint, track_id bigint, tenant_id string, name string, type_id string, order_number bigint, workload_minutes bigint, "
        "starts_at timestamp_ntz, ends_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz, updated_by string, "
        "is_active boolean, is_visible boolean, allows_time_bonus boolean",
        [
            (300, 200, "t1", "Past", "padrao", 1, 60, d("2020-01-01"), d("2020-02-01"), d("2019-01-01"), d("2019-01-02"), "9", True, True, True),
            (301, 200, "t1", "Now", "padrao", 2, 0, d("2020-05-01"), d("2020-07-01"), d("2019-01-01"), d("2019-01-02"), "x", True, True, False),
            (302, 200, "t1", "Next", "padrao", 3, None, d("2020-09-01"), d("2020-10-01"), d("2019-01-01"), d("2019-01-02"), None, True, True, True),
            (300, 200, "t2", "Past two", "padrao", 1, 60, d("2020-01-01"), d("2020-02-01"), d("2019-01-01"), d("2019-01-02"), "9", True, True, True),
        ],
    ),
    "roles": (
        "user_id bigint, entity_id bigint, entity_type string, role_id bigint, origin_created bigint, origin_updated bigint, created_by string, "
        "updated_by string, created_at timestamp_ntz, tenant_id string",
        [
            (1, 300, "RD", 1, 1, 1, "9", "9", d("2020-01-01"), "t1"), (1, 301, "RD", 2, 3, 1, "sync", "9", d("2020-01-02"), "t1"),
            (2, 300, "RD ", 1, 4, 1, "77", "9", d("2020-01-01"), "t1"), (5, 300, "RD", 3, 2, 1, "5", "9", d("2020-01-01"), "t1"),
            (9, 300, "RD", 1, None, 1, None, "9", d("2020-01-01"), "t1"), (1, 300, "RD", 2, 1, 1, "9", "9", d("2020-01-01"), "t2"),
        ],
    ),
    "attempts": (
        "attempt_id bigint, user_id bigint, tenant_id string, module_id bigint, status_id string, grade decimal(10,2), points decimal(18,2), "
        "challenge_bonus decimal(18,2), time_bonus decimal(18,2), access_seconds bigint, created_at timestamp_ntz, updated_at timestamp_ntz",
        [],
    ),
    "activities": (
        "activity_id bigint, tenant_id string, type_id string, title string, statement string, workload_minutes bigint, is_active boolean",
        [(400, "t1", "dissertativa", "Essay", "Write", 20, True), (401, "t1", "scorm", "Play", None, None, True), (400, "t2", "scorm", "Other", None, 5, True)],
    ),
    "achievements": ("achievement_id bigint, tenant_id string", [(500, "t1")]),
    "entity_groups": (
        "entity_id bigint, entity_type string, group_id bigint, tenant_id string",
        [
            (1, "US", 10, "t1"), (1, "US", 12, "t1"), (2, "US", 11, "t1"), (5, "US", 14, "t1"), (9, "US", 11, "t1"), (100, "CP", 10, "t1"), (100, "CP", 11, "t1"),
            (1, "US", 10, "t2"), (9, "US", 10, "t2"), (400, "AT", 10, "t1"), (401, "AT", 13, "t1"),
        ],
    ),
    "admin_profiles": (
        "profile_id bigint, access_kind string, sees_ungrouped boolean, is_active boolean, tenant_id string",
        [
            (1, "any_group", True, True, "t1"), (2, "group_structure_top_down", False, True, "t1"), (3, "specific_groups", False, True, "t1"),
            (4, "any_group", True, False, "t1"), (1, "any_group", False, True, "t2"),
        ],
    ),
    "profile_groups": ("profile_id bigint, group_id bigint, tenant_id string", [(3, 14, "t1"), (4, 10, "t1")]),
    "attributes": (
        "attribute_id bigint, tenant_id string, name string, type_id bigint, is_active boolean",
        [
            (1, "t1", "t1_cargo", 1, True), (2, "t1", "t1_idade", 2, True), (3, "t1", "t1_desc._uni.", 7, True), (4, "t1", "t1_Cargo", 4, True),
            (5, "t1", "t1_old", 1, False), (1, "t2", "t2_cargo", 1, True),
        ],
    ),
    "attribute_types": ("type_id bigint, name string", [(1, "TEXT"), (2, "INTEGER"), (4, "DATE"), (5, "TIME"), (7, "SELECT")]),
    "attribute_items": ("attribute_id bigint, order_number bigint, tenant_id string", [(i, i, "t1") for i in range(1, 6)] + [(1, 1, "t2")]),
    "entity_attributes": (
        "entity_attribute_id bigint, entity_id bigint, entity_type string, attribute_id bigint, value_id bigint, text_value string, date_value date, "
        "time_value string, tenant_id string",
        [
            (1, 1, "US", 1, None, "old", None, None, "t1"), (2, 1, "US", 1, None, " Gerência ", None, None, "t1"), (3, 1, "US", 2, None, "41", None, None, "t1"),
            (4, 1, "US", 3, 7, None, None, None, "t1"), (5, 1, "US", 4, None, None, date(2020, 2, 3), None, "t1"), (6, 2, "US", 1, None, "", None, None, "t1"),
            (7, 2, "US", 2, None, "n/a", None, None, "t1"), (8, 2, "US", 3, 8, None, None, None, "t1"), (9, 1, "US", 1, None, "two", None, None, "t2"),
            (10, 1, "US", 5, None, "hidden", None, None, "t1"),
        ],
    ),
    "attribute_values": ("value_id bigint, label_id bigint, tenant_id string", [(7, 70, "t1"), (8, 80, "t1")]),
    "labels": ("label_id bigint, key string, is_default boolean", [(70, "k70", True), (80, "k80", True), (90, "k90", False)]),
    "label_texts": (
        "label_id bigint, language_id string, text string",
        [(70, "pt-BR", "Sim"), (70, "en", "Yes"), (80, "pt-PT", "Outro"), (80, "es", "Otro"), (90, "fr", "Oui"), (90, "es", "Si")],
    ),
    "label_overrides": ("label_id bigint, language_id string, tenant_id string, text string", [(70, "pt-BR", "t1", " Claro ")]),
    "audiences": ("audience_id bigint, tenant_id string, name string", [(5, "t1", "Managers")]),
    "imports": ("import_id bigint, tenant_id string, admin_id bigint", [(77, "t1", 9)]),
}


def build(spark, **overrides) -> Platform:
    frames = {name: spark.createDataFrame(data, ddl) for name, (ddl, data) in {**TABLES, **overrides}.items()}
    return Platform.from_frames(frames)
