import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import platform_fixture
from lumenpath.functions import codes
from lumenpath.functions.predicates import keep_listed
from lumenpath.operators import access, attributes, audience, content, labels, latest, provenance
from lumenpath.operators.audience import Criterion


@pytest.fixture(scope="module")
def p(spark):
    return platform_fixture.build(spark)


def with_admin(spark, *profiles):
    rows = [(profile, 9, "t1") for profile in profiles] + [(1, 9, "t2")]
    return platform_fixture.build(spark, profile_users=("profile_id bigint, user_id bigint, tenant_id string", rows))


def seen(platform, spark, kind, tenant="t1"):
    frame = access.editable_entities(platform, access.admin_frame(spark, 9, tenant), kind)
    return {(r.entity_id, r.is_linked) for r in frame.collect()}


def test_any_group_also_shows_ungrouped(spark):
    assert seen(with_admin(spark, 1), spark, codes.USER) == {(1, True), (2, True), (5, True), (9, True), (4, False), (6, False)}
    assert seen(with_admin(spark, 1), spark, codes.USER, "t2") == {(1, True), (9, True)}


def test_top_down_reaches_groups_below_the_admin(spark):
    assert seen(with_admin(spark, 2), spark, codes.USER) == {(1, True), (2, True), (9, True)}


def test_specific_groups_and_inactive_profile(spark):
    assert seen(with_admin(spark, 3), spark, codes.USER) == {(5, True)}
    # An inactive profile grants no reach, but its permission to see ungrouped entities counts.
    assert seen(with_admin(spark, 3, 4), spark, codes.USER) == {(5, True), (4, False), (6, False)}
    assert seen(with_admin(spark, 4), spark, codes.USER) == set()


def test_strongest_profile_wins(spark):
    profile = access.admin_profile(with_admin(spark, 3, 1, 2), access.admin_frame(spark, 9, "t1")).first()
    assert (profile.profile_id, profile.access_kind) == (1, "any_group")


def test_other_entity_types(spark):
    platform = with_admin(spark, 1)
    assert seen(platform, spark, codes.ENVIRONMENT) == {(100, True), (101, False)}
    assert seen(platform, spark, codes.ACTIVITY) == {(400, True), (401, False)}
    assert seen(platform, spark, codes.ACHIEVEMENT) == {(500, False)}


def test_all_groups_order_and_filter(p):
    got = {(r.user_id, r.tenant_id): r.all_groups for r in access.all_groups(p).collect()}
    assert got[(1, "t1")] == "Root, Leaf" and got[(1, "t2")] == "Root two" and (6, "t1") not in got
    only = {(r.user_id, r.tenant_id): r.all_groups for r in access.all_groups(p, group_ids=[12, 11]).collect()}
    assert only == {(1, "t1"): "Leaf", (2, "t1"): "Child", (9, "t1"): "Child"}


def test_first_group_prefers_an_active_parent(p):
    got = {(r.user_id, r.tenant_id): (r.child_group_id, r.parent_group_id) for r in latest.first_group(p).collect()}
    assert got[(1, "t1")] == (12, 11) and got[(5, "t1")] == (14, None) and got[(1, "t2")] == (10, None)


def test_labels(p, rows):
    wanted = rows([(70, "t1"), (70, "t2"), (80, "t1"), (90, "t1")], "label_id bigint, tenant_id string")
    got = {(r.label_id, r.tenant_id): (r.language_id, r.text) for r in labels.label_text(p, wanted, "pt-br").collect()}
    assert got == {(70, "t1"): ("pt-BR", " Claro "), (70, "t2"): ("pt-BR", "Sim"), (80, "t1"): ("es", "Otro"), (90, "t1"): ("es", "Si")}
    assert {r.text for r in labels.label_text(p, wanted.where("label_id = 80"), "pt").collect()} == {"Outro"}


def test_attributes_latest_and_columns(p):
    got = {(r.user_id, r.tenant_id, r.attribute_id): r.value for r in attributes.user_attributes(p).collect()}
    assert got[(1, "t1", 1)] == "Gerência" and got[(1, "t1", 3)] == "Claro" and got[(1, "t1", 4)] == "03/02/2020" and got[(1, "t2", 1)] == "two"
    assert (1, "t1", 5) not in got
    one = p.for_tenant("t1")
    names = attributes.attribute_names(one)
    assert names == ["cargo", "idade", "desc._uni.", "Cargo"]
    report = one.users.select("user_id", "tenant_id", "full_name")
    wide = attributes.with_attribute_columns(one, report)
    assert wide.columns[3:] == ["cargo", "idade", "desc._uni.", "Cargo (2)"]
    row = wide.where("user_id = 1").first()
    assert (row["cargo"], row["desc._uni."], row["Cargo (2)"]) == ("Gerência", "Claro", "03/02/2020")
    assert wide.count() == report.count()


def test_hierarchy_and_plan_keep_tenants_apart(p):
    modules = content.module_hierarchy(p)
    assert modules.count() == modules.select("tenant_id", "environment_id", "module_id").distinct().count() == 4
    plan = content.user_plan(p, p.modules.select("module_id", "tenant_id", F.col("name").alias("module_name")))
    assert {(r.user_id, r.tenant_id, r.module_name) for r in plan.collect()} == {
        (1, "t1", "Past"), (1, "t1", "Now"), (2, "t1", "Past"), (5, "t1", "Past"), (9, "t1", "Past"), (1, "t2", "Past two")
    }


def test_provenance(p):
    links = content.module_roles(p).select("user_id", "tenant_id", "module_id", "origin_created", "created_by")
    got = {(r.user_id, r.tenant_id, r.module_id): r.linked_by for r in provenance.with_provenance(p, links, "origin_created", "created_by").collect()}
    assert got[(1, "t1", 300)] == "Admin" and got[(1, "t2", 300)] == "Other Admin" and got[(1, "t1", 301)] == "sync"
    assert got[(2, "t1", 300)] == "Admin" and got[(5, "t1", 300)] == "Managers" and got[(9, "t1", 300)] is None


def test_provenance_without_a_broadcast(p, monkeypatch):
    links = content.module_roles(p).select("user_id", "tenant_id", "module_id", "origin_created", "created_by")
    names = lambda: sorted(provenance.with_provenance(p, links, "origin_created", "created_by").collect(), key=str)
    small = names()
    monkeypatch.setattr(provenance, "BROADCAST_BYTES", -1)
    assert names() == small
    keys = provenance.creator_names(p, links, "origin_created", "created_by")
    assert keys.count() == keys.select("_origin", "_key", "tenant_id").distinct().count()


def test_first_group_without_a_broadcast(p, monkeypatch):
    for wanted in ({}, {"per_environment": False}, {"group_ids": (10,)}):
        small = sorted(latest.first_group(p, **wanted).collect(), key=str)
        with monkeypatch.context() as patch:
            patch.setattr(latest, "BROADCAST_BYTES", -1)
            assert sorted(latest.first_group(p, **wanted).collect(), key=str) == small


def test_user_status_codes_and_long_lists(p, monkeypatch):
    from lumenpath.functions import predicates

    users = p.users
    count = lambda codes: users.where(F.lit(True) if (c := predicates.with_flag(F.col("is_active"), codes)) is None else c).count()
    assert count((7,)) == 0 and count((1, 0)) == count(()) == count((0, 9)) + count((1,)) and count((0, 9)) == count((0,))
    groups = p.groups
    short = sorted(predicates.keep_either_listed(groups, ["group_id", "parent_group_id"], (10, 11, 10)).collect(), key=str)
    monkeypatch.setattr(predicates, "LITERAL_VALUES", 1)
    assert sorted(predicates.keep_either_listed(groups, ["group_id", "parent_group_id"], (10, 11, 10)).collect(), key=str) == short and short
    assert predicates.keep_all_listed(groups, {"group_id": (10, 11), "tenant_id": ("t1", "t9")}).count() == groups.where("group_id in (10, 11) and tenant_id = 't1'").count()


ATTEMPT = platform_fixture.TABLES["attempts"][0]


def attempts(spark, triples):
    rows = [(i, u, "t1", m, s, None, None, None, None, None, None, None) for i, u, m, s in triples]
    return spark.createDataFrame(rows, ATTEMPT)


def test_cancelled_attempts_never_count(spark):
    frame = attempts(spark, [(1, 1, 300, "aprovado"), (2, 1, 300, "cancelado"), (3, 2, 300, "cancelado")])
    assert [(r.attempt_id, r.is_approved) for r in latest.latest_attempt(frame).collect()] == [(1, True)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(300, 301), st.sampled_from(["cancelado", "aprovado", "em_andamento"])), max_size=25), st.integers(1, 4))
def test_attempt_numbers_against_brute_force(spark, attempts_in, keep):
    triples = [(i, *t) for i, t in enumerate(attempts_in)]
    want = set()
    for key in {(u, m) for _, u, m, _ in triples}:
        mine = [i for i, u, m, s in triples if (u, m) == key and s != "cancelado"]
        want |= {(i, n) for n, i in enumerate(mine, 1) if n > len(mine) - keep}
    got = {(r.attempt_id, r.attempt_number) for r in latest.attempt_history(attempts(spark, triples), keep).collect()}
    assert got == want


def test_every_attempt_is_kept_unless_a_limit_is_given(spark):
    frame = attempts(spark, [(i, 1, 300, "aprovado") for i in range(150)])
    got = sorted((r.attempt_id, r.attempt_number) for r in latest.attempt_history(frame).collect())
    assert got == [(i, i + 1) for i in range(150)]
    assert latest.attempt_history(frame, 100).count() == 100


def test_group_filter_chooses_among_the_listed_groups(p):
    groups = {(r.user_id, r.tenant_id, r.child_group_id) for r in p.group_members.selectExpr("user_id", "tenant_id", "group_id child_group_id").collect()}
    for wanted in sorted({g for *_, g in groups}):
        for row in latest.first_group(p, group_ids=(wanted,)).collect():
            assert wanted in (row.child_group_id, row.parent_group_id) and (row.user_id, row.tenant_id, row.child_group_id) in groups
    both = {r.user_id for r in latest.first_group(p, group_ids=(10,)).where("tenant_id = 't1'").collect()}
    assert 1 in both


def test_long_lists_are_joined(spark, rows):
    frame = rows([(1, "a"), (5, "b"), (None, "c")], "user_id bigint, name string")
    for values in ([1, 7], list(range(1, 5000, 2)) + [1]):
        assert sorted(r.name for r in keep_listed(frame, "user_id", values).collect()) == (["a"] if len(values) == 2 else ["a", "b"])
    assert keep_listed(frame, "user_id", ()).count() == 3


def test_unknown_roles_match_nothing(rows):
    labels = codes.DICTIONARIES["role"]
    gold = rows([("t1", labels["1"]), ("t1", "?")], "tenant_id string, role_label string")
    from lumenpath.plans.activity import _with_roles

    assert gold.where(_with_roles(gold["role_label"], (9,))).count() == 0
    assert gold.where(_with_roles(gold["role_label"], (9, 1))).count() == 1
    assert _with_roles(gold["role_label"], ()) is None


def members(p, include, exclude=()):
    return {(r.user_id, r.tenant_id) for r in audience.audience(p, include, exclude).collect()}


def criterion(kind, entity_type="AV", **rest):
    return Criterion("t1", entity_type, kind, **rest)


def test_empty_text_criterion(p):
    # Blank value (2) and no row at all (5, 6, 9); 2 is inactive and so left out.
    assert members(p, [criterion("is_empty", attribute_id=1, entity_id=0)]) == {(5, "t1"), (6, "t1"), (9, "t1")}


def test_two_empty_criteria_are_two_criteria(p):
    include = [criterion("is_empty", attribute_id=1, entity_id=0), criterion("equal_to", attribute_id=2, entity_id=0, value="41")]
    assert audience.required_criteria(include) == {"t1": 2} and members(p, include) == set()


def test_alternatives_of_one_attribute_count_once(p):
    either = [criterion("equal_to", attribute_id=3, entity_id=7), criterion("equal_to", attribute_id=3, entity_id=8)]
    assert audience.required_criteria(either) == {"t1": 1} and members(p, either) == {(1, "t1")}


def test_all_criteria_and_exceptions(p):
    include = [
        criterion("contains", attribute_id=1, entity_id=0, value="GERENCIA"), criterion("group", "GR", entity_id=12),
        criterion("userProfile", "UP", entity_id=2), criterion("greater_than", attribute_id=2, entity_id=0, value="40"),
    ]
    assert members(p, include) == {(1, "t1")}
    assert members(p, include, [criterion("user", "US", entity_id=1)]) == set()
    assert members(p, include, [criterion("group", "GR", entity_id=11)]) == {(1, "t1")}
    assert members(p, []) == set()


def test_status_criterion_reaches_inactive_users(p):
    assert members(p, [criterion("userStatus", "SU", entity_id=0)]) == {(2, "t1")}


def test_more_criteria_than_one_mask_word_holds(spark, p, monkeypatch):
    monkeypatch.setattr(audience, "WORD_BITS", 2)
    names = [(i, "t1", f"t1_a{i}", 2, True) for i in range(100, 105)]
    values = [(i, 1, "US", i, None, "5", None, None, "t1") for i in range(100, 105)] + [(i + 500, 5, "US", i, None, "5", None, None, "t1") for i in range(100, 104)]
    wide = platform_fixture.build(
        spark, attributes=(platform_fixture.TABLES["attributes"][0], names), entity_attributes=(platform_fixture.TABLES["entity_attributes"][0], values)
    )
    assert members(wide, [criterion("equal_to", attribute_id=i, entity_id=0, value="5") for i in range(100, 105)]) == {(1, "t1")}


def test_page_shows_the_size_of_the_whole_audience(p):
    include = [criterion("userStatus", "SU", entity_id=1)]
    whole = audience.audience_users(p, include).collect()
    page = audience.audience_users(p, include, skip=1, take=2).collect()
    assert [r.name for r in page] == [r.name for r in whole][1:3] and {r.total_users for r in page} == {len(whole)}
    found = audience.audience_users(p, include, search="eva man").collect()
    assert [(r.user_id, r.total_users) for r in found] == [(5, 1)]
    with pytest.raises(ValueError):
        audience.audience_users(p, include, skip=1)


def test_table_functions_from_sql(p, spark):
    from lumenpath.operators import table_functions

    facts = "group_label string, order_number bigint, help_label string, group_order bigint, config_order bigint, config_group_order bigint, config_tab string, config_group string"
    setting = "setting_id string, description string, file string, is_active boolean, is_visible boolean"
    row = ("s1", "one", "f", True, True, "g", 1, "h", 1, 1, 1, "t", "c")
    own = "setting_id string, tenant_id string, file string, is_active boolean, is_visible boolean"
    extended = platform_fixture.build(
        spark, settings=(f"{setting}, {facts}", [row]), environment_settings=(f"{setting}, {facts}", [row]),
        tenant_settings=(own, [("s1", "t1", "mine", False, None)]),
        profile_users=("profile_id bigint, user_id bigint, tenant_id string", [(1, 9, "t1")]),
        tenant_environment_settings=(own + ", environment_id bigint", []), achievements=("achievement_id bigint, tenant_id string", []),
    )
    names = table_functions.register(extended)
    assert [r["file"] for t in ("t1", "t2", "t9") for r in spark.sql(f"SELECT * FROM settings_of('{t}')").collect()] == ["mine", "f"]
    assert all(spark.catalog.functionExists(name) for name in names)
    one = spark.sql("SELECT * FROM all_groups_of(1, 't1', NULL)")
    whole = {(r.user_id, r.tenant_id): r.all_groups for r in access.all_groups(p).collect()}
    assert [r.all_groups for r in one.collect()] == [whole[1, "t1"]]
    assert spark.sql("SELECT * FROM all_groups_of(1, 't1', array(-1L))").collect() == [] == spark.sql("SELECT * FROM all_groups_of(1, NULL, NULL)").collect()
    best = {(r.label_id, r.tenant_id): r.text for r in labels.label_text(p, p.labels.select("label_id").join(p.users.select("tenant_id").distinct()), "pt-BR").collect()}
    found = spark.sql("SELECT w.label_id, t.* FROM (SELECT DISTINCT label_id, tenant_id FROM rows_of_label_text_of) w, LATERAL label_text_of(w.label_id, w.tenant_id, 'pt-BR') t")
    assert {(r[0], r.tenant_id): r.text for r in found.collect()} == best
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "user_id" in plan and " = 1)" in plan and "= t1)" in plan


def test_attribute_columns_are_bounded_and_of_the_tenants_asked_for(p, spark, monkeypatch):
    from lumenpath.operators import attributes

    tenants = spark.createDataFrame([("t1",)], "tenant_id string")
    mine, all_names = attributes.attribute_names(p, tenants), attributes.attribute_names(p)
    assert mine and set(mine) <= set(all_names)
    assert attributes.attribute_names(p, tenants.where("false")) == []
    monkeypatch.setattr(attributes, "MOST_COLUMNS", len(all_names) - 1)
    with pytest.raises(attributes.TooManyColumns):
        attributes.attribute_names(p)


def test_a_catalogue_too_large_for_a_broadcast_is_refused(p, monkeypatch):
    monkeypatch.setattr(labels, "BROADCAST_BYTES", 0)
    with pytest.raises(ValueError):
        labels.for_each(p.users.select("tenant_id"), p.labels)
