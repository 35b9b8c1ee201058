"""Stand-ins: the learning-platform tables, derived from the driver's parquet tables.

Each entry is one portable SELECT.  Spark runs it over the parquet frames; the checking SQL
uses the same text as a CTE, so both sides start from the same rows and differ only in how the
operator under test is written.  ``{name}`` refers to a parquet table or to another entry.

Dialect marks: ``@TS'..'`` a timestamp without zone, ``@TENANTS`` one row per tenant,
``@SEQ(a,b)`` one row per integer, ``@JAN1(y)`` the first instant of a year.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lumenpath.operators.sizes import dealt
from lumenpath.plans.gold import activity_time_gold
from lumenpath.sources import Platform
from lumenpath.sources.staging import Stage

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

AS_OF = "2000-01-01 00:00:00"

# The customer segments, which play the tenants.
TENANTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

_P = "cast(substring(o_orderpriority, 1, 1) as bigint)"
_MODULE = f"cast(year(o_orderdate) as bigint) * 10 + {_P}"
# The stored states of an attempt and types of an activity.
_STATUS = """case when o_orderstatus = 'P' and o_totalprice < 200000 then 'cancelado'
                  when o_orderstatus = 'P' and o_totalprice < 350000 then 'nao_iniciado'
                  when o_orderstatus = 'P' then 'aguardando_correcao'
                  when o_orderstatus = 'O' then 'em_andamento'
                  when o_totalprice < 150000 then 'aprovado'
                  when o_totalprice < 250000 then 'reprovado'
                  when o_totalprice < 400000 then 'concluido'
                  else 'realizado_fora_prazo' end"""
_TYPE = """case k when 1 then 'multipla_escolha' when 2 then 'dissertativa' when 3 then 'formulario'
                when 4 then 'minigame' when 5 then 'scorm' when 6 then 'verdadeiro_falso'
                else 'padrao_sou' end"""

TABLES: dict[str, str] = {
    # --- helpers -------------------------------------------------------------------------
    "order_owner": f"""
        select cast(o_orderkey as bigint) as attempt_id, cast(o_custkey as bigint) as user_id,
               c_mktsegment as tenant_id, c_nationkey as nation_id, c_acctbal as balance, {_MODULE} as module_id,
               cast(year(o_orderdate) as bigint) as track_id, {_P} as p, o_orderstatus, o_totalprice,
               o_orderdate, {_STATUS} as status_id
        from {{orders}} join {{customer}} on o_custkey = c_custkey""",
    "order_line": """
        select l.*, o.user_id, o.tenant_id, o.module_id, o.module_id * 10 + l.k as activity_id,
               1 + n_regionkey as environment_id
        from (select cast(l_orderkey as bigint) as attempt_id, cast(l_linenumber as bigint) as k,
                     cast(sum(l_quantity) as bigint) as units, min(l_shipdate) as first_ship,
                     max(l_shipdate) as last_ship, max(l_discount) as discount,
                     min(l_returnflag) as low_flag, max(l_returnflag) as high_flag,
                     min(l_linestatus) as line_status, cast(max(l_quantity) as bigint) as top_units
              from {lineitem} group by l_orderkey, l_linenumber) l
        join {order_owner} o on o.attempt_id = l.attempt_id
        join {nation} on n_nationkey = o.nation_id""",
    "module_key": f"""
        select year_id, p, tenant_id, year_id * 10 + p as module_id
        from (select year_id, p, @TENANTS as tenant_id
              from (select distinct cast(year(o_orderdate) as bigint) as year_id, {_P} as p from {{orders}}) d) e""",
    "track_key": """
        select year_id, @TENANTS as tenant_id
        from (select distinct cast(year(o_orderdate) as bigint) as year_id from {orders}) d""",
    "activity_key": """
        select year_id, p, tenant_id, module_id, k, module_id * 10 + k as activity_id
        from (select year_id, p, tenant_id, module_id, @SEQ(1,7) as k from {module_key}) e""",
    # --- people and groups -----------------------------------------------------------------
    "users": """
        select cast(c_custkey as bigint) as user_id, c_mktsegment as tenant_id, c_name as full_name,
               lower(c_name) || '@example.test' as email, 'login-' || cast(c_custkey as string) as login,
               c_acctbal >= 0 as is_active, c_acctbal > 9950 as is_default,
               case when c_acctbal < -950 then @TS'1999-06-01 00:00:00' end as deleted_at,
               @TS'1994-01-01 08:30:00' + interval '1' day * c_nationkey as created_at,
               @TS'1995-02-01 17:45:10' + interval '1' day * c_nationkey as updated_at,
               cast(c_nationkey as string) as created_by, cast(c_nationkey + 1 as string) as updated_by
        from {customer}""",
    "groups": """
        select cast(100 + n_nationkey as bigint) as group_id, @TENANTS as tenant_id,
               cast(1 + n_regionkey as bigint) as parent_group_id, n_name as name, n_nationkey <> 23 as is_active
        from {nation}
        union all
        select cast(1 + r_regionkey as bigint), @TENANTS, cast(null as bigint), r_name, r_regionkey <> 3
        from {region}""",
    "group_members": """
        select cast(c_custkey as bigint) as user_id, cast(100 + c_nationkey as bigint) as group_id,
               c_mktsegment as tenant_id
        from {customer} where not (c_acctbal >= 100 and c_acctbal <= 400)
        union all
        select cast(c_custkey as bigint), cast(1 + n_regionkey as bigint), c_mktsegment
        from {customer} join {nation} on c_nationkey = n_nationkey where c_acctbal > 5000""",
    "group_tree": """
        select cast(100 + n_nationkey as bigint) as root_id, cast(100 + n_nationkey as bigint) as group_id,
               cast(1 + n_regionkey as bigint) as parent_id, cast(0 as bigint) as hops, @TENANTS as tenant_id
        from {nation}
        union all
        select cast(1 + n_regionkey as bigint), cast(100 + n_nationkey as bigint), cast(1 + n_regionkey as bigint),
               cast(1 as bigint), @TENANTS from {nation}
        union all
        select cast(1 + r_regionkey as bigint), cast(1 + r_regionkey as bigint), cast(null as bigint),
               cast(0 as bigint), @TENANTS from {region}""",
    # --- content ---------------------------------------------------------------------------
    "environments": """
        select cast(1 + r_regionkey as bigint) as environment_id, @TENANTS as tenant_id, r_name as name,
               r_regionkey <> 4 as is_available from {region}
        union all
        select cast(51 + r_regionkey as bigint), @TENANTS, r_name || ' draft', r_regionkey < 2 from {region}""",
    "environment_groups": """
        select cast(1 + n_regionkey as bigint) as environment_id, cast(100 + n_nationkey as bigint) as group_id,
               @TENANTS as tenant_id from {nation} where n_nationkey <> 20
        union all
        select cast(1 + r_regionkey as bigint), cast(1 + r_regionkey as bigint), @TENANTS
        from {region} where r_regionkey <> 0""",
    "environment_tracks": """
        select @SEQ(1,5) as environment_id, year_id as track_id, tenant_id from {track_key}""",
    "tracks": """
        select year_id as track_id, tenant_id, 'Track ' || cast(year_id as string) as name,
               year_id <> 2001 as is_active, year_id <> 1996 as is_visible from {track_key}""",
    "modules": """
        select module_id, year_id as track_id, tenant_id, 'Module ' || cast(p as string) || ' of ' || cast(year_id as string) as name,
               case when p = 3 then 'recorrente' else 'padrao' end as type_id, 6 - p as order_number,
               case when p = 1 then 0 when p = 2 then cast(null as bigint) else 30 * p end as workload_minutes,
               @JAN1(year_id) + interval '1' day * (70 * (p - 1)) as starts_at,
               @JAN1(year_id) + interval '1' day * (70 * (p - 1) + 400) as ends_at,
               @JAN1(year_id) - interval '1' day * 20 as created_at,
               @JAN1(year_id) + interval '1' day * p as updated_at,
               case when p = 5 then 'system' else cast(p as string) end as updated_by,
               not (year_id = 1998 and p = 5) as is_active, not (year_id = 1999 and p = 4) as is_visible,
               p <= 2 as allows_time_bonus
        from {module_key}""",
    "module_links": """
        select 900000 + year_id as link_id, year_id as track_id, (year_id + 1) * 10 + 3 as target_module_id, tenant_id,
               case when year_id = 1995 then 'url' else 'round' end as kind,
               @JAN1(year_id) + interval '1' day * 10 as created_at, year_id <> 1997 as is_active
        from {track_key}""",
    "activities": f"""
        select activity_id, tenant_id, {_TYPE} as type_id,
               'Activity ' || cast(k as string) || ' of ' || cast(module_id as string) as title,
               case when k = 5 then cast(null as string) else 'Statement ' || cast(activity_id as string) end as statement,
               case when k = 1 then cast(null as bigint) else 5 * k end as workload_minutes,
               not (k = 7 and year_id = 1995) as is_active
        from {{activity_key}}""",
    "module_activities": """
        select module_id, activity_id, tenant_id, cast(k * 1.5 as decimal(10,2)) as weight from {activity_key}""",
    "activity_types": f"""
        select {_TYPE} as type_id, 100 + k as label_id, k in (2, 3) as requires_review
        from (select distinct cast(l_linenumber as bigint) as k from {{lineitem}}) d""",
    "user_weights": """
        select module_id, activity_id, user_id, tenant_id, cast(max(top_units) as decimal(10,2)) as weight
        from {order_line} where discount >= 0.09 group by module_id, activity_id, user_id, tenant_id""",
    # --- who takes part ----------------------------------------------------------------------
    "roles": """
        select user_id, module_id as entity_id, 'RD' as entity_type,
               cast(case when top_price > 250000 then 1 when top_price > 100000 then 2 else 3 end as bigint) as role_id,
               origin as origin_created, cast(1 as bigint) as origin_updated,
               case when origin = 3 then 'api-client' when origin = 4 then cast(user_id as string)
                    when origin is null then cast(null as string) else cast(nation_id as string) end as created_by,
               cast(nation_id + 1 as string) as updated_by, since as created_at, tenant_id
        from (select user_id, tenant_id, nation_id, module_id, max(o_totalprice) as top_price, min(o_orderdate) as since,
                     cast(case when p = 5 then 3 when p = 4 then null when min(o_orderstatus) = 'F' then 1
                               when min(o_orderstatus) = 'O' then 2 else 4 end as bigint) as origin
              from (select user_id, tenant_id, nation_id, module_id, p, o_totalprice, o_orderdate, o_orderstatus from {order_owner}
                    where not (balance > 600 and balance < 800)
                    union all
                    select user_id, tenant_id, nation_id, module_id + 10, p, o_totalprice, o_orderdate, o_orderstatus from {order_owner}
                    where not (balance > 600 and balance < 800)) s
              group by user_id, tenant_id, nation_id, module_id, p) g
        union all
        select cast(c_custkey as bigint), cast(1999 as bigint), 'TR', cast(2 as bigint), cast(1 as bigint), cast(null as bigint),
               cast(null as string), cast(null as string), @TS'1998-12-01 00:00:00', c_mktsegment
        from {customer} where c_acctbal > 8500
        union all
        select cast(c_custkey as bigint), cast(901998 as bigint), 'RL', cast(1 as bigint), cast(1 as bigint), cast(null as bigint),
               cast(null as string), cast(null as string), @TS'1998-12-01 00:00:00', c_mktsegment
        from {customer} where c_acctbal > 7500 and c_acctbal <= 8500""",
    "attempts": """
        select attempt_id, user_id, tenant_id, module_id, status_id, cast(p as decimal(10,2)) as grade,
               cast(o_totalprice as decimal(18,2)) as points,
               case when p <= 3 then cast(p * 10 as decimal(18,2)) end as challenge_bonus,
               case when p <> 2 then cast(5 as decimal(18,2)) end as time_bonus,
               case when p = 5 then cast(null as bigint) else cast(floor(o_totalprice / 100) as bigint) end as access_seconds,
               o_orderdate as created_at, o_orderdate + interval '1' day * 30 as updated_at
        from {order_owner}""",
    "activity_access": """
        select attempt_id, activity_id, tenant_id, units * 60 as seconds, first_ship as created_at,
               last_ship as updated_at from {order_line} where high_flag <> 'A'""",
    "answers": """
        select attempt_id, activity_id, user_id, environment_id, tenant_id,
               case when low_flag <> 'A' then last_ship + interval '1' day * 1 end as answered_at, first_ship as created_at,
               cast(discount as decimal(18,4)) as hit_ratio,
               case when k = 2 then 'essay ' || cast(units as string) end as essay_text,
               case when high_flag = 'R' then 'feedback ' || cast(k as string) end as feedback,
               high_flag <> 'N' as is_reviewed
        from {order_line} where line_status = 'F'""",
    "exemptions": """
        select module_id, user_id, tenant_id, min(o_orderdate) as exempted_at,
               case when p <= 2 then null when p = 3 then @TS'1999-06-01 00:00:00' else @TS'2000-06-01 00:00:00' end as starts_at,
               case when p <= 2 then null when p = 3 then @TS'1999-09-01 00:00:00' else @TS'2000-09-01 00:00:00' end as ends_at
        from {order_owner} where o_totalprice < 30000 and not (balance > 9000 and balance < 9500) group by module_id, user_id, tenant_id, p
        union all
        select m.module_id, cast(c_custkey as bigint), m.tenant_id, @TS'1994-12-01 00:00:00', null, null
        from {customer} join {module_key} m on m.tenant_id = c_mktsegment where c_acctbal > 9000 and c_acctbal < 9500""",
    # --- answers in detail ---------------------------------------------------------------------
    "choices": """
        select activity_id * 10 + t as choice_id, activity_id, tenant_id, 'option ' || cast(t as string) as text, t <> 8 as is_active
        from (select activity_id, tenant_id, @SEQ(0,8) as t from {activity_key} where k in (1, 6)) e""",
    "choice_answers": """
        select o.attempt_id, o.module_id * 10 + l.l_linenumber as activity_id,
               (o.module_id * 10 + l.l_linenumber) * 10 + cast(round(l_tax * 100) as bigint) as choice_id,
               o.user_id, cast(1 + n_regionkey as bigint) as environment_id, o.tenant_id, l.l_returnflag <> 'R' as is_correct
        from {lineitem} l join {order_owner} o on l.l_orderkey = o.attempt_id
        join {nation} on n_nationkey = o.nation_id where l.l_linenumber in (1, 6)""",
    "form_questions": """
        select activity_id * 10 + q as question_id, activity_id, tenant_id, not (q = 2 and year_id = 1996) as is_active
        from (select activity_id, tenant_id, year_id, @SEQ(1,2) as q from {activity_key} where k = 3) e""",
    "form_answers": """
        select activity_id * 10 + q as question_id, attempt_id, tenant_id,
               case when q = 1 then 'note ' || cast(units as string) end as essay_text,
               case when q = 2 then top_units end as scale
        from (select activity_id, attempt_id, tenant_id, units, top_units, @SEQ(1,2) as q
              from {order_line} where k = 3) e""",
    "form_choices": """
        select 7000 + t as choice_id, tenant_id, 'form option ' || cast(t as string) as text
        from (select t, @TENANTS as tenant_id from (select distinct cast(round(l_tax * 100) as bigint) as t from {lineitem}) d) e""",
    "form_choice_answers": """
        select distinct (o.module_id * 10 + l.l_linenumber) * 10 + 1 as question_id, o.attempt_id,
               7000 + cast(round(l_tax * 100) as bigint) as choice_id, o.tenant_id, l.l_returnflag <> 'A' as is_selected
        from {lineitem} l join {order_owner} o on l.l_orderkey = o.attempt_id where l.l_linenumber = 3""",
    "minigame_answers": """
        select attempt_id, module_id as question_id, tenant_id from {order_line} where k = 4""",
    "minigame_choices": """
        select 8000 + t as choice_id, tenant_id, 'card ' || cast(t as string) as text, t <> 0 as is_active
        from (select t, @TENANTS as tenant_id from (select distinct cast(round(l_tax * 100) as bigint) as t from {lineitem}) d) e""",
    "minigame_choice_answers": """
        select distinct o.attempt_id, o.module_id as question_id, 8000 + cast(round(l_tax * 100) as bigint) as choice_id,
               o.tenant_id, l.l_returnflag <> 'N' as is_selected
        from {lineitem} l join {order_owner} o on l.l_orderkey = o.attempt_id where l.l_linenumber = 4""",
    # --- progress ------------------------------------------------------------------------------
    "track_progress": """
        select user_id * 10 + (track_id - 1995) as progress_id, user_id, tenant_id, track_id, environment_id,
               case when track_id = 1998 then last_key when track_id = 1999 then 0 end as recertification_attempt_id,
               first_day as first_access_at, last_day as finished_at, score,
               case when track_id = 1997 then cast(null as bigint) else total * 1800 end as workload_seconds, total * 725 as access_seconds,
               total as total_modules, awaiting as awaiting_modules, approved as approved_modules, done as finished_modules,
               exempt as exempt_modules, running as in_progress_modules, expired as expired_modules,
               idle as not_started_modules, closed as not_released_modules, late as late_modules, failed as failed_modules
        from (select o.user_id, o.tenant_id, o.track_id, cast(1 + n_regionkey as bigint) as environment_id, max(attempt_id) as last_key,
                     min(o_orderdate) as first_day, max(o_orderdate) as last_day, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as score,
                     count(*) as total, count(case when o_totalprice < 30000 then 1 end) as exempt,
                     count(case when status_id = 'aguardando_correcao' then 1 end) as awaiting,
                     count(case when status_id in ('aprovado', 'concluido') or balance > 8000 then 1 end) as approved,
                     count(case when status_id in ('aprovado', 'concluido', 'reprovado', 'realizado_fora_prazo') or balance > 8000 then 1 end) as done,
                     count(case when status_id = 'em_andamento' and track_id >= 1997 then 1 end) as running,
                     count(case when status_id = 'em_andamento' and track_id < 1997 then 1 end) as expired,
                     count(case when status_id in ('nao_iniciado', 'cancelado') and track_id < 2000 then 1 end) as idle,
                     count(case when status_id in ('nao_iniciado', 'cancelado') and track_id >= 2000 then 1 end) as closed,
                     count(case when status_id = 'realizado_fora_prazo' then 1 end) as late,
                     count(case when status_id = 'reprovado' then 1 end) as failed
              from {order_owner} o join {nation} on n_nationkey = o.nation_id
              group by o.user_id, o.tenant_id, o.track_id, n_regionkey) g""",
    "recertifications": """
        select 500 + year_id as recertification_id, year_id as track_id, tenant_id,
               case when year_id <= 1996 then 365 else 900 end as expiry_days, 30 as available_days,
               true as for_mandatory, year_id <> 1998 as for_participant, year_id <> 1997 as is_active
        from {track_key} where year_id < 2000""",
    "environment_scores": """
        select cast(1 + n_regionkey as bigint) as environment_id, o.user_id, o.tenant_id, cast(0 as bigint) as ranking_id,
               cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as score
        from {order_owner} o join {nation} on n_nationkey = o.nation_id group by o.user_id, o.tenant_id, n_regionkey""",
    "entity_access": """
        select o.user_id, cast(1 + n_regionkey as bigint) as entity_id, 'CP' as entity_type, o.tenant_id,
               max(o_orderdate) as last_access_at
        from {order_owner} o join {nation} on n_nationkey = o.nation_id where o_orderstatus = 'F'
        group by o.user_id, o.tenant_id, n_regionkey""",
    # --- attributes, labels, settings --------------------------------------------------------------
    "attribute_key": """
        select event_type, cast(case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
                                     when 'signup' then 4 else 5 end as bigint) as attribute_id,
               cast(case event_type when 'click' then 2 when 'error' then 1 when 'purchase' then 3
                                    when 'signup' then 7 else 4 end as bigint) as type_id
        from (select distinct event_type from {events}) d
        union all select 'phone', cast(6 as bigint), cast(8 as bigint)
        union all select 'skills', cast(7 as bigint), cast(6 as bigint)
        union all select 'shift', cast(8 as bigint), cast(5 as bigint)""",
    "attributes": """
        select attribute_id, tenant_id, tenant_id || '_' || event_type as name, type_id, true as is_active
        from (select event_type, attribute_id, type_id, @TENANTS as tenant_id from {attribute_key}) e
        union all
        select cast(99 as bigint), tenant_id, tenant_id || '_legacy', cast(1 as bigint), false
        from (select @TENANTS as tenant_id from {region} where r_regionkey = 0) e""",
    "attribute_types": """
        select cast(1 as bigint) as type_id, 'TEXT' as name union all select cast(2 as bigint), 'INTEGER'
        union all select cast(3 as bigint), 'DECIMAL' union all select cast(4 as bigint), 'DATE'
        union all select cast(5 as bigint), 'TIME' union all select cast(6 as bigint), 'MULTIPLE'
        union all select cast(7 as bigint), 'SELECT' union all select cast(8 as bigint), 'PHONE'""",
    "attribute_items": """
        select attribute_id, attribute_id as order_number, @TENANTS as tenant_id from {attribute_key}""",
    "entity_attributes": """
        select cast(event_id as bigint) as entity_attribute_id, cast(e.user_id as bigint) as entity_id, 'US' as entity_type,
               k.attribute_id, case when e.event_type = 'signup' then cast(1 + least(floor(value / 40), 4) as bigint) end as value_id,
               case e.event_type when 'click' then cast(cast(floor(value) as bigint) as string)
                    when 'error' then ' code-' || cast(cast(floor(value / 10) as bigint) as string) || ' '
                    when 'purchase' then cast(cast(value as decimal(18,2)) as string)
                    when 'view' then cast(cast(ts as date) as string) end as text_value,
               case when e.event_type = 'view' then cast(ts as date) end as date_value, cast(null as string) as time_value,
               c_mktsegment as tenant_id
        from {events} e join {attribute_key} k on k.event_type = e.event_type join {customer} on c_custkey = e.user_id
        union all
        select cast(1000000000 + c_custkey as bigint), cast(c_custkey as bigint), 'US', cast(6 as bigint), cast(null as bigint),
               ' ' || cast(10 + c_nationkey as string) || '-555-' || cast(1000 + c_custkey as string) || ' ', cast(null as date), cast(null as string), c_mktsegment
        from {customer} where c_custkey % 3 <> 0
        union all
        select cast(2000000000 as bigint) + c_custkey, cast(c_custkey as bigint), 'US', cast(7 as bigint), cast(1 + c_nationkey % 5 as bigint),
               cast(null as string), cast(null as date), cast(null as string), c_mktsegment
        from {customer} where c_custkey % 4 <> 1
        union all
        select cast(3000000000 as bigint) + c_custkey, cast(c_custkey as bigint), 'US', cast(7 as bigint), cast(1 + c_custkey % 5 as bigint),
               cast(null as string), cast(null as date), cast(null as string), c_mktsegment
        from {customer} where c_custkey % 2 = 0
        union all
        select cast(4000000000 as bigint) + c_custkey, cast(c_custkey as bigint), 'US', cast(8 as bigint), cast(null as bigint),
               cast(null as string), cast(null as date), '0' || cast(c_nationkey % 10 as string) || ':30:00', c_mktsegment
        from {customer} where c_custkey % 5 <> 2""",
    "attribute_values": """
        select 1 + cast(r_regionkey as bigint) as value_id, 201 + cast(r_regionkey as bigint) as label_id, @TENANTS as tenant_id from {region}""",
    "labels": """
        select cast(n_nationkey as bigint) as label_id, 'label.nation.' || cast(n_nationkey as string) as key, n_nationkey < 20 as is_default from {nation}
        union all select 100 + k, 'label.type.' || cast(k as string), true from (select distinct cast(l_linenumber as bigint) as k from {lineitem}) d
        union all select 201 + cast(r_regionkey as bigint), 'label.value.' || cast(r_regionkey as string), false from {region}""",
    "label_texts": """
        select cast(n_nationkey as bigint) as label_id, 'pt' as language_id, n_name || ' (pt)' as text from {nation} where n_regionkey in (0, 4)
        union all select cast(n_nationkey as bigint), 'pt-BR', n_name || ' (pt-BR)' from {nation} where n_regionkey in (0, 1)
        union all select cast(n_nationkey as bigint), 'pt-PT', n_name || ' (pt-PT)' from {nation} where n_regionkey = 1
        union all select cast(n_nationkey as bigint), 'en-US', n_name || ' (en)' from {nation} where n_regionkey in (0, 1, 2)
        union all select cast(n_nationkey as bigint), 'es-ES', n_name || ' (es)' from {nation} where n_regionkey in (2, 3, 4)
        union all select 100 + k, 'pt-BR', 'Tipo ' || cast(k as string) from (select distinct cast(l_linenumber as bigint) as k from {lineitem}) d
        union all select 100 + k, 'en-US', 'Type ' || cast(k as string) from (select distinct cast(l_linenumber as bigint) as k from {lineitem}) d
        union all select 201 + cast(r_regionkey as bigint), 'pt-BR', ' ' || r_name || ' ' from {region}
        union all select 201 + cast(r_regionkey as bigint), 'en-US', r_name || ' en' from {region}""",
    "label_overrides": """
        select label_id, case when odd_region = 1 then 'pt-BR' else 'pt' end as language_id, tenant_id, tenant_id || ' ' || s_name as text
        from (select cast(n_nationkey as bigint) as label_id, n_regionkey as odd_region, s_name, @TENANTS as tenant_id
              from (select s_nationkey, min(s_suppkey) as low_key from {supplier} group by s_nationkey) f
              join {supplier} s on s.s_suppkey = f.low_key join {nation} on n_nationkey = s.s_nationkey) e
        where tenant_id in ('BUILDING', 'MACHINERY')
        union all
        select label_id, 'pt-BR', tenant_id, tenant_id || ' type' from (select cast(101 + r_regionkey as bigint) as label_id, @TENANTS as tenant_id from {region}) e
        where tenant_id = 'FURNITURE'""",
    "settings": """
        select 'setting-' || p_brand as setting_id, 'about ' || p_brand as description, 'file-' || p_brand as file,
               p_brand like '%1' as is_active, true as is_visible, 'group ' || substring(p_brand, 7, 1) as group_label,
               cast(substring(p_brand, 7) as bigint) as order_number, 'help ' || p_brand as help_label,
               cast(substring(p_brand, 7, 1) as bigint) as group_order, cast(substring(p_brand, 7) as bigint) + 1 as config_order,
               cast(substring(p_brand, 7, 1) as bigint) + 1 as config_group_order, cast(1 as bigint) as config_tab, 'general' as config_group
        from (select distinct p_brand from {part}) d""",
    "tenant_settings": """
        select setting_id, tenant_id, case when tenant_id = 'BUILDING' then 'file-' || tenant_id end as file,
               not is_active as is_active, case when tenant_id = 'MACHINERY' then false end as is_visible
        from (select setting_id, is_active, @TENANTS as tenant_id from {settings}) e
        where tenant_id <> 'HOUSEHOLD' and setting_id like '%2%'""",
    "environment_settings": """
        select setting_id, description, file, is_active, is_visible, group_label, order_number, help_label, group_order,
               config_order, config_group_order, config_tab, config_group from {settings}
        union all
        select 'count_partial_score_in_rankings', 'partial score', cast(null as string), false, true, 'ranking', cast(1 as bigint),
               'help', cast(1 as bigint), cast(1 as bigint), cast(1 as bigint), cast(1 as bigint), 'ranking' from {region} where r_regionkey = 0""",
    "tenant_environment_settings": """
        select setting_id, environment_id, tenant_id, 'file-' || cast(environment_id as string) as file,
               environment_id < 3 as is_active, cast(null as boolean) as is_visible
        from (select setting_id, 1 + cast(r_regionkey as bigint) as environment_id, @TENANTS as tenant_id
              from (select 'count_partial_score_in_rankings' as setting_id, r_regionkey from {region}
                    union all select 'setting-Brand#5', r_regionkey from {region}) r) e
        where tenant_id <> 'HOUSEHOLD'""",
    # --- provenance, access ---------------------------------------------------------------------------
    "audiences": """
        select cast(n_nationkey as bigint) as audience_id, @TENANTS as tenant_id, 'Audience ' || n_name as name from {nation}""",
    "imports": """
        select cast(c_custkey as bigint) as import_id, c_mktsegment as tenant_id, cast(c_nationkey as bigint) as admin_id from {customer}""",
    "achievements": """
        select brand as achievement_id, @TENANTS as tenant_id
        from (select distinct cast(substring(p_brand, 7) as bigint) as brand from {part}) d""",
    "entity_groups": """
        select user_id as entity_id, 'US' as entity_type, group_id, tenant_id from {group_members}
        union all select environment_id, 'CP', group_id, tenant_id from {environment_groups}
        union all select activity_id, 'AT', k, tenant_id from {activity_key} where k <= 5 and year_id < 1999
        union all select achievement_id, 'CQ', 100 + achievement_id, tenant_id from {achievements} where achievement_id < 24""",
    "admin_profiles": """
        select profile_id, access_kind, sees_ungrouped, is_active, @TENANTS as tenant_id
        from (select cast(1 as bigint) as profile_id, 'any_group' as access_kind, true as sees_ungrouped, true as is_active
              union all select cast(2 as bigint), 'group_structure_top_down', false, true
              union all select cast(3 as bigint), 'specific_groups', false, true
              union all select cast(4 as bigint), 'any_group', false, false
              union all select cast(5 as bigint), 'specific_groups', true, true) d""",
    "profile_users": """
        select cast(1 as bigint) as profile_id, cast(min(c_custkey) as bigint) as user_id, c_mktsegment as tenant_id from {customer} group by c_mktsegment
        union all select cast(3 as bigint), cast(min(c_custkey) as bigint), c_mktsegment from {customer} group by c_mktsegment
        union all select cast(2 as bigint), cast(max(c_custkey) as bigint), c_mktsegment from {customer} where c_acctbal > 5000 group by c_mktsegment
        union all select cast(3 as bigint), cast(min(c_custkey) as bigint), c_mktsegment from {customer} where c_acctbal > 1000 and c_acctbal < 5000 group by c_mktsegment
        union all select cast(4 as bigint), cast(min(c_custkey) as bigint), c_mktsegment from {customer} where c_acctbal > 1000 and c_acctbal < 5000 group by c_mktsegment
        union all select cast(5 as bigint), cast(min(c_custkey) as bigint), c_mktsegment from {customer} where c_acctbal > 1000 and c_acctbal < 5000 group by c_mktsegment""",
    "profile_groups": """
        select case when n_nationkey < 5 then cast(3 as bigint) else cast(5 as bigint) end as profile_id,
               cast(100 + n_nationkey as bigint) as group_id, @TENANTS as tenant_id from {nation} where n_nationkey < 10""",
    "any_admins": "select user_id as admin_id, tenant_id from {profile_users} where profile_id = 1",
    "tree_admins": "select user_id as admin_id, tenant_id from {profile_users} where profile_id = 2",
    "specific_admins": "select user_id as admin_id, tenant_id from {profile_users} where profile_id = 5",
}

#: Users of whom ``roles`` knows nothing, for the queries that look for people who play nowhere.
_PLAYS_NOWHERE = "where not (balance > 600 and balance < 800)"
#: Users whose modules ``track_progress`` all counts as approved, for the queries that look for people who finished a competition.
_TAKEN_AS_DONE = " or balance > 8000"

# The same tables without what they leave out or add for other queries.
TABLES["whole_roles"] = TABLES["roles"].replace(_PLAYS_NOWHERE, "")
TABLES["counted_progress"] = TABLES["track_progress"].replace(_TAKEN_AS_DONE, "")

#: What a query reads in place of a stand-in that makes its job smaller.
INSTEAD: dict[str, dict[str, str]] = {
    "module_status_rows": {"roles": "whole_roles"},
    "module_status_columns": {"roles": "whole_roles"},
    "track_report": {"roles": "whole_roles", "track_progress": "counted_progress"},
    "environment_report": {"roles": "whole_roles"},
}

_REF = re.compile(r"\{([a-z_]\w*)\}")
_QUOTED = ", ".join(f"'{t}'" for t in TENANTS)


def _spark_text(sql: str) -> str:
    sql = sql.replace("@TS'", "timestamp_ntz'").replace("@TENANTS", f"explode(array({_QUOTED}))")
    sql = re.sub(r"@SEQ\((\d+),(\d+)\)", r"explode(sequence(cast(\1 as bigint), cast(\2 as bigint)))", sql)
    return re.sub(r"@JAN1\((\w+)\)", r"make_timestamp_ntz(cast(\1 as int), 1, 1, 0, 0, 0)", sql)


def _duck_text(sql: str) -> str:
    sql = sql.replace("@TS'", "timestamp '").replace("@TENANTS", f"unnest([{_QUOTED}])")
    sql = re.sub(r"@SEQ\((\d+),(\d+)\)", r"unnest(range(\1, \2 + 1))", sql)
    sql = re.sub(r"@JAN1\((\w+)\)", r"make_timestamp(\1, 1, 1, 0, 0, 0.0)", sql)
    return _REF.sub(r"\1", sql)


_STAGES: dict[tuple[str, str], Stage] = {}


def stage_for(spark: SparkSession, sf_dir: str) -> Stage:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGES:
        _STAGES[key] = Stage(spark, sf_dir.strip("/").replace("/", "_"))
    return _STAGES[key]


def standin(spark: SparkSession, sf_dir: str, query: str = "") -> Platform:
    """The platform tables of one data directory, each written once, as the silver layer of a platform is.

    ``gold`` is the consolidated activity table built from them, partitioned by tenant.  ``query`` gets its own tables of ``INSTEAD``.
    """
    stage = stage_for(spark, sf_dir)

    def load(name: str) -> DataFrame:
        if name in BASE_TABLES:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return stage.keep(name, lambda: derive(name), ("tenant_id",) if name == "gold" else ())

    def derive(name: str) -> DataFrame:
        if name == "gold":
            return activity_time_gold(Platform(load), AS_OF)
        text = TABLES[name]
        frames = {ref: load(ref) for ref in set(_REF.findall(text))}
        if name == "order_line":
            # Lines travel once: their grouping and the join to their order both find them dealt by order.
            frames["lineitem"] = dealt(frames["lineitem"], ["l_orderkey"])
        return spark.sql(_spark_text(text), **frames)

    instead = INSTEAD.get(query, {})
    return Platform(lambda name: load(instead.get(name, name)))


def with_tables(body: str, blocks: dict[str, str] | None = None, query: str = "") -> str:
    """Checking SQL: ``body`` with a CTE for every stand-in or block it names as ``{name}``; ``query`` as in ``standin``."""
    known = {**TABLES, **(blocks or {})}
    known |= {name: TABLES[other] for name, other in INSTEAD.get(query, {}).items()}
    needed: list[str] = []

    def visit(text: str) -> None:
        for ref in _REF.findall(text):
            if ref not in BASE_TABLES and ref not in needed:
                visit(known[ref])
                needed.append(ref)

    visit(body)
    ctes = ",\n".join(f"{name} as ({_duck_text(known[name])})" for name in needed)
    body = _duck_text(body).strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
