"""Activity facts: what an activity takes from its attempt, and how often rows travel."""

from decimal import Decimal

from lumenpath.operators.answers import choice_answers, form_answers
from lumenpath.params import ReportParams
from lumenpath.plans.activity import activity_report
from lumenpath.plans.gold import activity_facts, activity_time_gold
from platform_fixture import build, d

AS_OF = "2020-06-01 00:00:00"
ATTEMPTS = (
    "attempt_id bigint, user_id bigint, tenant_id string, module_id bigint, status_id string, grade decimal(10,2), points decimal(18,2), "
    "challenge_bonus decimal(18,2), time_bonus decimal(18,2), access_seconds bigint, created_at timestamp_ntz, updated_at timestamp_ntz",
    [(n, 1, "t1", m, "em_andamento", None, None, None, None, 1, d("2020-01-05"), d("2020-01-06")) for n, m in ((50, 300), (51, 300), (52, 301))]
    + [(51, 1, "t2", 300, "em_andamento", None, None, None, None, 1, d("2020-01-05"), d("2020-01-06"))],
)
EXTRA = {
    "attempts": ATTEMPTS,
    "activity_types": ("type_id string, label_id bigint, requires_review boolean", [("dissertativa", 70, True), ("scorm", 80, False), ("formulario", 90, False)]),
    "activities": (
        "activity_id bigint, tenant_id string, type_id string, title string, statement string, workload_minutes bigint, is_active boolean",
        [(400, "t1", "dissertativa", "Essay", "Write", 20, True), (401, "t1", "scorm", "Play", None, None, True), (402, "t1", "formulario", "Form", None, 5, True),
         (400, "t2", "scorm", "Other", None, 5, True)],
    ),
    "module_activities": (
        "module_id bigint, activity_id bigint, tenant_id string, weight decimal(10,2)",
        [(m, a, t, Decimal(w)) for m, a, t, w in ((300, 400, "t1", 1), (300, 401, "t1", 2), (300, 402, "t1", 3), (301, 401, "t1", 4), (300, 400, "t2", 5))],
    ),
    # Attempt 51 has two rows for one activity, one for an unknown one, and a namesake in the other tenant.
    "activity_access": (
        "attempt_id bigint, activity_id bigint, tenant_id string, seconds bigint, created_at timestamp_ntz, updated_at timestamp_ntz",
        [(n, a, t, s, d("2020-01-07"), d("2020-01-08")) for n, a, t, s in (
            (50, 400, "t1", 9), (51, 401, "t1", 10), (51, 401, "t1", 11), (51, None, "t1", 12), (51, 400, "t2", 13), (None, 400, "t1", 14))],
    ),
    "answers": (
        "attempt_id bigint, activity_id bigint, user_id bigint, environment_id bigint, tenant_id string, answered_at timestamp_ntz, "
        "created_at timestamp_ntz, hit_ratio decimal(18,4), essay_text string, feedback string, is_reviewed boolean",
        [(51, 400, u, e, "t1", d("2020-01-09"), d("2020-01-09"), None, text, None, False)
         for u, e, text in ((1, 100, "mine"), (2, 100, "of another user"), (1, 101, "elsewhere"), (None, 100, "nobody's"))],
    ),
    "user_weights": (
        "module_id bigint, activity_id bigint, user_id bigint, tenant_id string, weight decimal(10,2)",
        [(300, a, 1, t, Decimal(w)) for a, t, w in ((400, "t1", 7), (402, "t1", 8), (402, "t1", 9), (401, "t2", 10))],
    ),
    "exemptions": ("module_id bigint, user_id bigint, tenant_id string, exempted_at timestamp_ntz, starts_at timestamp_ntz, ends_at timestamp_ntz", []),
    "choices": ("choice_id bigint, activity_id bigint, tenant_id string, text string, is_active boolean", []),
    "choice_answers": ("attempt_id bigint, activity_id bigint, choice_id bigint, user_id bigint, environment_id bigint, tenant_id string, is_correct boolean", []),
    "form_questions": ("question_id bigint, activity_id bigint, tenant_id string, is_active boolean", [(1, 402, "t1", True), (2, 402, "t1", True)]),
    "form_answers": ("question_id bigint, attempt_id bigint, tenant_id string, essay_text string, scale bigint", [(2, 51, "t1", None, 3), (1, 51, "t1", "note", None)]),
    "form_choices": ("choice_id bigint, tenant_id string, text string", []),
    "form_choice_answers": ("question_id bigint, attempt_id bigint, choice_id bigint, tenant_id string, is_selected boolean", []),
    "minigame_answers": ("attempt_id bigint, question_id bigint, tenant_id string", []),
    "minigame_choices": ("choice_id bigint, tenant_id string, text string, is_active boolean", []),
    "minigame_choice_answers": ("attempt_id bigint, question_id bigint, choice_id bigint, tenant_id string, is_selected boolean", []),
}


def test_an_activity_takes_its_own_from_the_attempt(spark):
    facts = activity_facts(build(spark, **EXTRA), AS_OF).where("user_id = 1")
    found = {tuple(r) for r in facts.select("tenant_id", "module_id", "activity_id", "attempt_id", "access_seconds", "answer_text", "activity_weight").collect()}
    assert facts.count() == 7 and {(*r[:-1], float(r[-1])) for r in found} == {
        ("t1", 300, 400, 51, None, "mine", 7.0), ("t1", 300, 401, 51, 10, None, 2.0), ("t1", 300, 401, 51, 11, None, 2.0),
        ("t1", 300, 402, 51, None, "note, 3", 8.0), ("t1", 300, 402, 51, None, "note, 3", 9.0), ("t1", 301, 401, 52, None, None, 4.0),
        ("t2", 300, 400, 51, 13, None, 5.0),
    }


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString().splitlines()


def _without_automatic_broadcasts(spark, check):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        check()
    finally:
        spark.conf.set(key, before)


def test_gold_rows_pass_through_no_exchange_once_they_are_by_activity(spark):
    platform = build(spark, **EXTRA)

    def check():
        plan = _plan(activity_facts(platform, AS_OF))
        last = next(i for i, line in enumerate(plan) if "Generate explode" in line)
        assert not [line for line in plan[:last] if "Exchange hashpartitioning" in line or "Sort [" in line]
        # The names of the users are joined before modules become activities.
        plan = _plan(activity_time_gold(platform, AS_OF))
        last = next(i for i, line in enumerate(plan) if "Generate explode" in line)
        assert not [line for line in plan[:last] if "Exchange hashpartitioning(user_id" in line]

    _without_automatic_broadcasts(spark, check)


def test_answers_are_collected_behind_one_exchange(spark):
    platform = build(spark, **EXTRA)

    def check():
        for frame in (choice_answers(platform), form_answers(platform)):
            plan = _plan(frame)
            first = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(attempt_id" in line)
            # Neither step of the aggregation, both of which sort, runs before the rows are dealt.
            assert len([line for line in plan[:first] if "collect_list" in line and "Aggregate" in line]) == 2

    _without_automatic_broadcasts(spark, check)


def test_report_makes_text_of_instants_behind_its_sort(spark):
    profiles = {
        "profile_users": ("profile_id bigint, user_id bigint, tenant_id string", [(1, 1, "t1")]),
        "profile_groups": ("profile_id bigint, group_id bigint, tenant_id string", [(1, 1, "t1")]),
    }
    platform = build(spark, **EXTRA, **profiles)
    admins = spark.createDataFrame([(1, "t1")], "admin_id bigint, tenant_id string")
    report = activity_report(platform, activity_time_gold(platform, AS_OF), ReportParams(as_of=AS_OF), admins)
    assert {report.schema[name].dataType.simpleString() for name in ("first_access_at", "last_access_at", "answered_at")} == {"string"}
    plan = report._jdf.queryExecution().optimizedPlan().toString().splitlines()
    sort = next(i for i, line in enumerate(plan) if "Sort [full_name" in line)
    text = [i for i, line in enumerate(plan) if "date_format" in line and "first_access_at" in line]
    assert text and max(text) < sort
