"""Checking SQL for the registered queries, in DuckDB's dialect.

Written from the rules of each report, with EXISTS, correlated top-1 rows and window functions, and
not from the Spark plans.  ``{name}`` is a stand-in table or one of the shared BLOCKS below.
"""

from __future__ import annotations

from workload.tables import TENANTS, with_tables

NOW = "timestamp '2000-01-01 00:00:00'"
CLOSED = "('concluido', 'aprovado', 'reprovado', 'realizado_fora_prazo')"
PASSED = "('concluido', 'aprovado')"


def clock(s: str) -> str:
    return f"printf('%02d:%02d:%02d', ({s}) // 3600, (({s}) % 3600) // 60, ({s}) % 60)"


def short(s: str) -> str:
    return f"printf('%d:%02d:%02d', ({s}) // 3600, (({s}) % 3600) // 60, ({s}) % 60)"


def minute(x: str) -> str:
    return f"strftime({x}, '%d/%m/%Y %H:%M')"


def second(x: str) -> str:
    return f"strftime({x}, '%d/%m/%Y %H:%M:%S')"


def comma(x: str) -> str:
    return f"replace(cast({x} as varchar), '.', ',')"


def share(a: str, b: str) -> str:
    return f"cast(cast({a} as double) / nullif({b}, 0) * 100 as decimal(18,2))"


def role(x: str, other: str = "'Não Participa'") -> str:
    return f"case {x} when 1 then 'Obrigatório' when 2 then 'Participa' when 3 then 'Gestor' else {other} end"


def origin(x: str) -> str:
    return f"case {x} when 1 then 'Manual' when 2 then 'Público Alvo' when 3 then 'API' when 4 then 'Importação de Dados' end"


ACTIVE = "case when u.is_active then 'Ativo' else 'Inativo' end"
REAL = "not u.is_default and u.deleted_at is null"


def editable(admins: str, kind: str) -> str:
    """Entities of a type that each admin may see, as four unioned branches and a priority."""
    parts = [
        f"""select p.admin_id, e.tenant_id, e.entity_id, true as is_linked
            from {{entity_groups}} e join prof p on p.tenant_id = e.tenant_id and p.access_kind = 'any_group'
            join {{groups}} g on g.group_id = e.group_id and g.tenant_id = e.tenant_id and g.is_active where e.entity_type = '{kind}'""",
        f"""select p.admin_id, e.tenant_id, e.entity_id, true
            from {{entity_groups}} e join prof p on p.tenant_id = e.tenant_id and p.access_kind = 'group_structure_top_down'
            join {{groups}} g on g.group_id = e.group_id and g.tenant_id = e.tenant_id and g.is_active
            where e.entity_type = '{kind}' and exists (
              select 1 from {{group_tree}} t join {{entity_groups}} a on a.group_id = t.root_id and a.tenant_id = t.tenant_id
              where a.entity_type = 'US' and a.entity_id = p.admin_id and t.group_id = e.group_id and t.tenant_id = e.tenant_id)""",
        f"""select p.admin_id, e.tenant_id, e.entity_id, true
            from {{entity_groups}} e join prof p on p.tenant_id = e.tenant_id and p.access_kind = 'specific_groups'
            join {{groups}} g on g.group_id = e.group_id and g.tenant_id = e.tenant_id and g.is_active
            where e.entity_type = '{kind}' and exists (
              select 1 from {{admin_profiles}} ap join {{profile_users}} pu on pu.profile_id = ap.profile_id and pu.tenant_id = ap.tenant_id
              join {{profile_groups}} pg on pg.profile_id = ap.profile_id and pg.tenant_id = ap.tenant_id
              where ap.is_active and pu.user_id = p.admin_id and ap.tenant_id = e.tenant_id and pg.group_id = e.group_id)"""
        + ("" if kind != "CP" else """ and exists (
              select 1 from {roles} r join {modules} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id and m.is_active
              join {environment_tracks} et on et.track_id = m.track_id and et.tenant_id = m.tenant_id
              where r.entity_type = 'RD' and r.role_id in (1, 2, 3) and r.user_id = p.admin_id and r.tenant_id = e.tenant_id
                and et.environment_id = e.entity_id)"""),
    ]
    loose = {
        "US": """select u.user_id as entity_id, u.tenant_id from {users} u where not u.is_default and not exists (
                   select 1 from {group_members} m where m.user_id = u.user_id and m.tenant_id = u.tenant_id)""",
        "CP": """select c.environment_id as entity_id, c.tenant_id from {environments} c where not exists (
                   select 1 from {environment_groups} eg join {groups} g on g.group_id = eg.group_id and g.tenant_id = eg.tenant_id and g.is_active
                   where eg.environment_id = c.environment_id and eg.tenant_id = c.tenant_id)""",
        "AT": """select a.activity_id as entity_id, a.tenant_id from {activities} a where not exists (
                   select 1 from {entity_groups} eg join {groups} g on g.group_id = eg.group_id and g.tenant_id = eg.tenant_id and g.is_active
                   where eg.entity_type = 'AT' and eg.entity_id = a.activity_id and eg.tenant_id = a.tenant_id)""",
        "CQ": """select a.achievement_id as entity_id, a.tenant_id from {achievements} a where not exists (
                   select 1 from {entity_groups} eg join {groups} g on g.group_id = eg.group_id and g.tenant_id = eg.tenant_id and g.is_active
                   where eg.entity_type = 'CQ' and eg.entity_id = a.achievement_id and eg.tenant_id = a.tenant_id)""",
    }[kind]
    parts.append(f"select p.admin_id, l.tenant_id, l.entity_id, false from ({loose}) l join prof p on p.tenant_id = l.tenant_id and p.sees_ungrouped")
    return f"""
        with prof as (
          select * from (
            select a.admin_id, a.tenant_id, p.access_kind,
                   (select max(cast(q.sees_ungrouped as int)) from {{profile_users}} v join {{admin_profiles}} q
                      on q.profile_id = v.profile_id and q.tenant_id = v.tenant_id
                     where v.user_id = a.admin_id and v.tenant_id = a.tenant_id) = 1 as sees_ungrouped,
                   row_number() over (partition by a.admin_id, a.tenant_id order by case p.access_kind when 'any_group' then 1
                     when 'group_structure_top_down' then 2 when 'specific_groups' then 3 else 4 end, p.profile_id) as rn
            from {admins} a join {{profile_users}} pu on pu.user_id = a.admin_id and pu.tenant_id = a.tenant_id
            join {{admin_profiles}} p on p.profile_id = pu.profile_id and p.tenant_id = pu.tenant_id and p.is_active) x where rn = 1),
        access as ({" union all ".join(parts)})
        select admin_id, tenant_id, entity_id, '{kind}' as entity_type, is_linked from (
          select *, row_number() over (partition by admin_id, tenant_id, entity_id order by case when is_linked then 1 else 2 end) as rn
          from access) y where rn = 1"""


EVERY_ADMIN = "(select * from {any_admins} union select * from {tree_admins} union select * from {specific_admins})"

_GROUP_PICK = """
    select {keys}, parent_group_id, parent_group_name, child_group_id, child_group_name from (
      select m.user_id, m.tenant_id{env}, pg.group_id as parent_group_id, pg.name as parent_group_name, g.group_id as child_group_id,
             g.name as child_group_name,
             row_number() over (partition by m.user_id, m.tenant_id{env} order by case when pg.group_id is null then 1 else 0 end, g.group_id) as rn
      from {{group_members}} m join {{groups}} g on g.group_id = m.group_id and g.tenant_id = m.tenant_id and g.is_active
      join {{environment_groups}} eg on eg.group_id = g.group_id and eg.tenant_id = g.tenant_id
      left join {{groups}} pg on pg.group_id = g.parent_group_id and pg.tenant_id = g.tenant_id and pg.is_active) x where rn = 1"""


def groups_text(only: str = "true") -> str:
    return f"""
        select user_id, tenant_id, string_agg(name, ', ' order by hops nulls first, depth, parent_group_id nulls first, group_id) as all_groups
        from (select m.user_id, m.tenant_id, g.group_id, g.name, g.parent_group_id, t.hops,
                     (select count(*) from {{group_tree}} d where d.group_id = g.group_id and d.tenant_id = g.tenant_id) as depth,
                     row_number() over (partition by m.user_id, m.tenant_id, m.group_id order by t.hops) as rn
              from {{group_members}} m join {{groups}} g on g.group_id = m.group_id and g.tenant_id = m.tenant_id and g.is_active
              left join {{group_tree}} t on t.group_id = g.group_id and t.tenant_id = g.tenant_id
              where {only}) x
        where rn = 1 group by user_id, tenant_id"""


def label(wanted: str, language: str) -> str:
    return f"""
        select label_id, tenant_id, key, language_id, text, is_default from (
          select w.label_id, w.tenant_id, l.key, t.language_id, coalesce(o.text, t.text) as text, l.is_default,
                 row_number() over (partition by w.label_id, w.tenant_id order by case when lower(t.language_id) = lower('{language}') then 1
                   when lower(t.language_id) like lower('{language}') || '%' then 2 else 4 end, t.language_id) as rn
          from ({wanted}) w join {{labels}} l on l.label_id = w.label_id join {{label_texts}} t on t.label_id = l.label_id
          left join {{label_overrides}} o on o.label_id = t.label_id and o.language_id = t.language_id and o.tenant_id = w.tenant_id) x
        where rn = 1"""


_EACH_TENANT = ", ".join(f"'{t}'" for t in TENANTS)
_ATTRIBUTES = ("click", "error", "purchase", "signup", "view", "phone", "skills", "shift")  # in attribute id order

MODULES_ACTIVE = [(y, p) for y in range(1995, 2001) for p in range(1, 6) if (y, p) != (1998, 5)]

MODULE_WINDOW = f"""case when x.exempted_at is not null and x.starts_at is not null and {NOW} < x.starts_at then 'not_current'
    when x.exempted_at is not null and (x.starts_at is null or x.starts_at > {NOW}) then 'null'
    when {NOW} between m.starts_at and m.ends_at then 'current'
    when {NOW} < coalesce(x.starts_at, m.starts_at) then 'not_current' else 'not_done' end"""

BLOCKS: dict[str, str] = {
    "x_latest": f"""
        select *, coalesce(points, 0) + coalesce(challenge_bonus, 0) + coalesce(time_bonus, 0) as total_score,
               status_id in {CLOSED} as is_done, status_id in {PASSED} as is_approved
        from (select *, row_number() over (partition by user_id, tenant_id, module_id order by attempt_id desc) as rn
              from {{attempts}} where status_id <> 'cancelado') a where rn = 1""",
    "x_numbered": f"""
        select *, row_number() over (partition by user_id, tenant_id, module_id order by attempt_id) as attempt_number,
               row_number() over (partition by user_id, tenant_id, module_id order by attempt_id desc) as newest,
               status_id in {CLOSED} as is_done
        from {{attempts}} where status_id <> 'cancelado'""",
    "x_first_group": _GROUP_PICK.format(keys="user_id, tenant_id, environment_id", env=", eg.environment_id").replace("{{", "{").replace("}}", "}"),
    "x_listed_group": _GROUP_PICK.format(keys="user_id, tenant_id, environment_id", env=", eg.environment_id").replace("{{", "{").replace("}}", "}").replace(
        "pg.is_active) x", "pg.is_active where g.group_id in (2, 3, 101, 104, 106, 108) or pg.group_id in (2, 3, 101, 104, 106, 108)) x"),
    "x_any_group": _GROUP_PICK.format(keys="user_id, tenant_id", env="").replace("{{", "{").replace("}}", "}"),
    "x_all_groups": groups_text(),
    "x_users_any": editable("{any_admins}", "US"),
    "x_envs_any": editable("{any_admins}", "CP"),
    "x_users_tree": editable("{tree_admins}", "US"),
    "x_envs_tree": editable("{tree_admins}", "CP"),
    "x_option": label("select distinct label_id, tenant_id from {attribute_values}", "pt-BR"),
    "x_type_label": label("select distinct ty.label_id, a.tenant_id from {activities} a join {activity_types} ty on ty.type_id = a.type_id", "pt-BR"),
    "x_attributes": """
        select u.user_id, u.tenant_id, a.attribute_id, trim(replace(a.name, a.tenant_id || '_', '')) as attribute,
               case when ty.name in ('TEXT', 'PHONE', 'INTEGER', 'DECIMAL') then trim(e.text_value)
                    when ty.name in ('SELECT', 'MULTIPLE') then trim(o.text)
                    when ty.name = 'DATE' then strftime(e.date_value, '%d/%m/%Y') when ty.name = 'TIME' then e.time_value end as value, e.value_id
        from (select *, row_number() over (partition by attribute_id, tenant_id, entity_id order by entity_attribute_id desc) as rn
              from {entity_attributes} where entity_type = 'US') e
        join {users} u on u.user_id = e.entity_id and u.tenant_id = e.tenant_id
        join {attributes} a on a.attribute_id = e.attribute_id and a.tenant_id = e.tenant_id and a.is_active
        join {attribute_types} ty on ty.type_id = a.type_id
        join {attribute_items} i on i.attribute_id = a.attribute_id and i.tenant_id = a.tenant_id
        left join {attribute_values} v on v.value_id = e.value_id and v.tenant_id = e.tenant_id
        left join {x_option} o on o.label_id = v.label_id and o.tenant_id = v.tenant_id
        where e.rn = 1""",
    "x_wide_attributes": "select user_id, tenant_id, "
    + ", ".join(f"max(case when attribute = '{a}' then value end) as {a}" for a in _ATTRIBUTES)
    + " from {x_attributes} group by user_id, tenant_id",
    "x_hierarchy": """
        select a.activity_id, a.tenant_id, a.type_id as activity_type_id, a.title as activity_name, a.statement, a.workload_minutes as activity_workload,
               a.is_active as activity_active, ma.module_id, ma.weight as default_weight, m.track_id, m.name as module_name, m.is_active as module_active,
               t.name as track_name, t.is_active as track_active, e.environment_id, e.name as environment_name, e.is_available as environment_active
        from {activities} a join {module_activities} ma on ma.activity_id = a.activity_id and ma.tenant_id = a.tenant_id
        join {modules} m on m.module_id = ma.module_id and m.tenant_id = ma.tenant_id
        join {tracks} t on t.track_id = m.track_id and t.tenant_id = m.tenant_id
        join {environment_tracks} et on et.track_id = t.track_id and et.tenant_id = t.tenant_id
        join {environments} e on e.environment_id = et.environment_id and e.tenant_id = et.tenant_id""",
    "x_choice": """
        select c.attempt_id, c.activity_id, c.tenant_id, string_agg(o.text, ', ' order by c.choice_id) as choice_text
        from {choice_answers} c join {choices} o on o.choice_id = c.choice_id and o.activity_id = c.activity_id and o.tenant_id = c.tenant_id and o.is_active
        where c.is_correct group by c.attempt_id, c.activity_id, c.tenant_id""",
    "x_form": """
        select w.attempt_id, q.activity_id, q.tenant_id,
               string_agg(concat_ws(', ', t.choice, w.essay_text, cast(w.scale as varchar)), ', ' order by q.question_id, t.choice_id nulls first) as form_text
        from {form_questions} q join {form_answers} w on w.question_id = q.question_id and w.tenant_id = q.tenant_id
        left join (select c.question_id, c.attempt_id, c.tenant_id, c.choice_id, o.text as choice from {form_choice_answers} c
                   join {form_choices} o on o.choice_id = c.choice_id and o.tenant_id = c.tenant_id where c.is_selected) t
          on t.question_id = q.question_id and t.attempt_id = w.attempt_id and t.tenant_id = q.tenant_id
        where q.is_active group by w.attempt_id, q.activity_id, q.tenant_id""",
    "x_game": """
        select g.attempt_id, g.tenant_id, string_agg(c.text, ', ' order by p.choice_id) as minigame_text
        from {minigame_answers} g left join {minigame_choice_answers} p
          on p.attempt_id = g.attempt_id and p.question_id = g.question_id and p.tenant_id = g.tenant_id and p.is_selected
        left join {minigame_choices} c on c.choice_id = p.choice_id and c.tenant_id = p.tenant_id and c.is_active
        group by g.attempt_id, g.tenant_id""",
    "x_facts": f"""
        select h.*, r.user_id, r.role_id, u.full_name, u.email, u.login, u.is_active, fg.parent_group_id, fg.parent_group_name, fg.child_group_id,
               fg.child_group_name, la.attempt_id, aa.seconds, aa.created_at as first_access_at, aa.updated_at as last_access_at, an.answered_at,
               an.hit_ratio, an.feedback, coalesce(w.weight, h.default_weight) as activity_weight,
               case when h.activity_type_id in ('multipla_escolha', 'verdadeiro_falso') then c.choice_text
                    when h.activity_type_id = 'dissertativa' then an.essay_text when h.activity_type_id = 'formulario' then f.form_text
                    when h.activity_type_id = 'minigame' then g.minigame_text end as answer_text,
               case when x.exempted_at is not null then 'exempted'
                    when an.created_at is null and m.ends_at < {NOW} then 'expired'
                    when not an.is_reviewed and ty.requires_review then 'awaiting_approval'
                    when aa.created_at is not null and an.created_at is null then 'in_progress'
                    when m.starts_at < {NOW} and la.attempt_id is null then 'not_started'
                    when m.starts_at > {NOW} then 'not_released'
                    when an.answered_at is not null or la.status_id in ('aprovado', 'concluido', 'reprovado') then 'finished'
                    else 'not_started' end as activity_status
        from {{x_hierarchy}} h
        join {{roles}} r on r.entity_id = h.module_id and r.tenant_id = h.tenant_id and r.entity_type = 'RD' and r.role_id in (1, 2, 3)
        join {{users}} u on u.user_id = r.user_id and u.tenant_id = r.tenant_id and {REAL}
        join {{x_first_group}} fg on fg.user_id = r.user_id and fg.tenant_id = r.tenant_id and fg.environment_id = h.environment_id
        join {{modules}} m on m.module_id = h.module_id and m.tenant_id = h.tenant_id
        left join {{activity_types}} ty on ty.type_id = h.activity_type_id
        left join {{x_latest}} la on la.user_id = r.user_id and la.tenant_id = r.tenant_id and la.module_id = h.module_id
        left join {{activity_access}} aa on aa.attempt_id = la.attempt_id and aa.tenant_id = la.tenant_id and aa.activity_id = h.activity_id
        left join {{answers}} an on an.attempt_id = la.attempt_id and an.tenant_id = la.tenant_id and an.activity_id = h.activity_id
          and an.user_id = la.user_id and an.environment_id = h.environment_id
        left join {{exemptions}} x on x.module_id = h.module_id and x.user_id = r.user_id and x.tenant_id = r.tenant_id
        left join {{user_weights}} w on w.module_id = h.module_id and w.activity_id = h.activity_id and w.user_id = r.user_id and w.tenant_id = r.tenant_id
        left join {{x_choice}} c on c.attempt_id = la.attempt_id and c.activity_id = h.activity_id and c.tenant_id = la.tenant_id
        left join {{x_form}} f on f.attempt_id = la.attempt_id and f.activity_id = h.activity_id and f.tenant_id = la.tenant_id
        left join {{x_game}} g on g.attempt_id = la.attempt_id and g.tenant_id = la.tenant_id""",
    "x_gold": f"""
        select f.user_id, f.full_name, f.email, f.login, case when f.is_active then 'Ativo' else 'Inativo' end as user_status, f.parent_group_id,
               f.parent_group_name, f.child_group_id, f.child_group_name, f.environment_id, f.environment_name, f.track_id, f.track_name, f.module_id,
               f.module_name, f.activity_id, f.activity_name,
               case when activity_status = 'exempted' then '' else cast(f.attempt_id as varchar) end as attempt_id,
               case when activity_status = 'exempted' then '' when f.activity_workload > 0 then cast(f.activity_workload as varchar) else '' end as activity_workload,
               tl.text as activity_type,
               case when activity_status = 'exempted' or f.seconds is null then '' else {clock("f.seconds")} end as access_time,
               case when activity_status <> 'exempted' then f.first_access_at end as first_access_at,
               case when activity_status <> 'exempted' then f.last_access_at end as last_access_at,
               case when activity_status <> 'exempted' then f.answered_at end as answered_at,
               case when activity_status = 'exempted' or f.hit_ratio is null then '' else cast(cast(f.hit_ratio * 100 as decimal(18,2)) as varchar) end as hit_percent,
               f.statement, case when activity_status = 'exempted' then '' else f.answer_text end as answer_text,
               case when activity_status = 'exempted' then '' else cast(f.activity_weight as varchar) end as activity_weight,
               case when activity_status = 'exempted' then '' else coalesce(f.feedback, '') end as feedback, f.activity_status,
               {role("f.role_id")} as role_label, f.tenant_id, f.activity_type_id, f.environment_active, f.track_active, f.module_active, f.activity_active
        from {{x_facts}} f left join {{activity_types}} ty on ty.type_id = f.activity_type_id
        left join {{x_type_label}} tl on tl.label_id = ty.label_id and tl.tenant_id = f.tenant_id""",
    "x_partial": """
        select e.environment_id, e.tenant_id, coalesce(
                 (select t.is_active from {tenant_environment_settings} t where t.setting_id = 'count_partial_score_in_rankings'
                    and t.environment_id = e.environment_id and t.tenant_id = e.tenant_id),
                 (select s.is_active from {environment_settings} s where s.setting_id = 'count_partial_score_in_rankings'), false) as is_on
        from {environments} e""",
    "x_workload": """
        select m.module_id, m.tenant_id, cast(case when s.total > 0 then s.total when m.workload_minutes > 0 then m.workload_minutes end as bigint) as workload_minutes
        from {modules} m left join lateral (
          select sum(a.workload_minutes) as total from {module_activities} ma join {activities} a on a.activity_id = ma.activity_id and a.tenant_id = ma.tenant_id
          where a.is_active and ma.module_id = m.module_id and ma.tenant_id = m.tenant_id) s on true""",
    "x_provenance": """
        select r.user_id, r.tenant_id, r.entity_id as module_id, r.role_id, r.created_at, r.origin_created, r.origin_updated, r.created_by, r.updated_by,
               case when r.origin_created = 1 then coalesce(vu.full_name, r.created_by) when r.origin_created = 2 then coalesce(pa.name, r.created_by)
                    when r.origin_created = 3 then r.created_by when r.origin_created = 4 then coalesce(ua.full_name, r.created_by) end as linked_by
        from {roles} r
        left join {users} vu on vu.user_id = try_cast(r.created_by as bigint) and vu.tenant_id = r.tenant_id and r.origin_created = 1
        left join {audiences} pa on pa.audience_id = try_cast(r.created_by as bigint) and pa.tenant_id = r.tenant_id and r.origin_created = 2
        left join {imports} im on im.import_id = try_cast(r.created_by as bigint) and im.tenant_id = r.tenant_id and r.origin_created = 4
        left join {users} ua on ua.user_id = im.admin_id and ua.tenant_id = im.tenant_id
        where r.entity_type = 'RD' and r.role_id in (1, 2, 3)""",
}


def module_facts(users: str, envs: str, roles_in: str, newest: str, modules_on: str, user_filter: str, row_filter: str) -> str:
    """Module rows in the row dialect, before formatting."""
    return f"""
        select *, max(completed_at) over (partition by tenant_id, user_id, environment_id) as last_completed_at,
               count(module_id) over (partition by tenant_id, user_id, environment_id, track_id) as track_modules,
               cast(sum(case when is_done then 1 else 0 end) over (partition by tenant_id, user_id, environment_id, track_id) as bigint) as track_modules_done
        from (
          select z.*, case when "window" = 'null' then 'exempted' when status_id = 'aguardando_correcao' then 'awaiting_approval'
                   when is_done then case status_id when 'aprovado' then 'approved' when 'reprovado' then 'reproved' when 'realizado_fora_prazo' then 'out_of_date' else 'finished' end
                   when "window" = 'current' then case when status_id is null then 'not_started' else 'in_progress' end
                   when "window" = 'not_current' then case when status_id is null and {NOW} < coalesce(exempt_start, starts_at) then 'not_released'
                        when status_id = 'em_andamento' then 'in_progress' else 'not_started' end
                   when "window" = 'not_done' then 'expired' end as module_status
          from (
            select l.user_id, l.tenant_id, l.module_id, l.role_id, l.created_at as linked_at, l.origin_created, l.linked_by, u.full_name, u.email, u.login, u.is_active,
                   e.environment_id, e.name as environment_name, t.track_id, t.name as track_name, substring(m.name, 1, 127) as module_name, m.starts_at, m.ends_at,
                   m.created_at as module_created_at, m.updated_at as module_updated_at, ed.full_name as updated_by, wl.workload_minutes, ps.is_on as counts_partial,
                   fg.parent_group_id, fg.parent_group_name, fg.child_group_id, fg.child_group_name, a.attempt_id, a.status_id, a.points, a.challenge_bonus, a.time_bonus,
                   a.access_seconds, a.attempt_number, coalesce(a.is_done, false) as is_done, x.starts_at as exempt_start,
                   case when a.status_id <> 'nao_iniciado' then a.created_at end as first_access_at,
                   case when a.status_id <> 'nao_iniciado' and (a.status_id in {CLOSED} or m.type_id = 'recorrente') then a.updated_at end as completed_at,
                   {MODULE_WINDOW} as "window"
            from {{x_provenance}} l
            join {{users}} u on u.user_id = l.user_id and u.tenant_id = l.tenant_id and {REAL} and {user_filter}
            join {{modules}} m on m.module_id = l.module_id and m.tenant_id = l.tenant_id and m.is_visible and {modules_on}
            join {{tracks}} t on t.track_id = m.track_id and t.tenant_id = m.tenant_id and t.is_active
            join {{environment_tracks}} et on et.track_id = t.track_id and et.tenant_id = t.tenant_id
            join {{environments}} e on e.environment_id = et.environment_id and e.tenant_id = et.tenant_id and e.is_available
            join {{x_first_group}} fg on fg.user_id = l.user_id and fg.tenant_id = l.tenant_id and fg.environment_id = e.environment_id
            join {{x_workload}} wl on wl.module_id = m.module_id and wl.tenant_id = m.tenant_id
            join {{x_partial}} ps on ps.environment_id = e.environment_id and ps.tenant_id = e.tenant_id
            left join {{users}} ed on ed.user_id = try_cast(m.updated_by as bigint) and ed.tenant_id = m.tenant_id
            left join {{x_numbered}} a on a.user_id = l.user_id and a.tenant_id = l.tenant_id and a.module_id = m.module_id and a.newest <= {newest}
            left join {{exemptions}} x on x.user_id = l.user_id and x.tenant_id = l.tenant_id and x.module_id = m.module_id
            where exists (select 1 from {{{users}}} v where v.entity_id = l.user_id and v.tenant_id = l.tenant_id)
              and exists (select 1 from {{{envs}}} v where v.entity_id = e.environment_id and v.tenant_id = e.tenant_id)
              and exists (select 1 from {{roles}} o where o.entity_type = 'RD' and o.user_id = l.user_id and o.entity_id = l.module_id and o.tenant_id = l.tenant_id
                          and o.role_id in {roles_in})) z where {row_filter}) q"""


BLOCKS["x_module_rows"] = module_facts("x_users_any", "x_envs_any", "(1, 2, 3)", "1", "m.is_active", "u.is_active", "true")
_W = "between timestamp '1996-06-01 00:00:00' and timestamp '1999-06-30 00:00:00'"
BLOCKS["x_module_attempts"] = module_facts(
    "x_users_any", "x_envs_any", "(1, 2)", "100", "true", "true",
    f"linked_at between timestamp '1995-01-01 00:00:00' and timestamp '2000-12-31 00:00:00' "
    f"and (first_access_at {_W} or completed_at {_W} or first_access_at is null)",
)

BLOCKS["x_cells"] = f"""
    select *, case when "window" = 'null' then 'Disp/Inat' when status_id = 'aguardando_correcao' then 'Aguardando Correção'
                   when is_done then case status_id when 'aprovado' then 'Aprovado' when 'reprovado' then 'Reprovado' else 'Concluido' end
                   when "window" = 'current' then case when status_id is null or status_id = 'nao_iniciado' then 'Não Iniciado' else 'Em Andamento' end
                   when "window" = 'not_current' then case when status_id = 'em_andamento' then 'Em Andamento' else 'Não Iniciado' end
                   when "window" = 'not_done' then 'Não Realizado' end as status_text
    from (
      select r.user_id, r.tenant_id, r.role_id, m.module_id, m.name as module_name, m.order_number, m.starts_at, m.ends_at, t.track_id, t.name as track_name,
             e.environment_id, e.name as environment_name, u.full_name, u.email, u.login, u.is_active, fg.parent_group_id, fg.parent_group_name, fg.child_group_id,
             fg.child_group_name, a.attempt_id, a.status_id, a.total_score, coalesce(a.is_done, false) as is_done, coalesce(a.is_approved, false) as is_approved,
             a.created_at as first_access_at, case when a.is_done or m.type_id = 'recorrente' then a.updated_at end as finished_at,
             x.module_id is not null as is_exempt, x.starts_at as exempt_start, x.ends_at as exempt_end, {MODULE_WINDOW} as "window",
             row_number() over (partition by r.user_id, r.tenant_id, e.environment_id, t.track_id order by coalesce(x.starts_at, m.starts_at), m.order_number, m.module_id) as module_index
      from {{roles}} r
      join {{users}} u on u.user_id = r.user_id and u.tenant_id = r.tenant_id and {REAL}
      join {{modules}} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id and m.is_active
      join {{tracks}} t on t.track_id = m.track_id and t.tenant_id = m.tenant_id and t.is_active
      join {{environment_tracks}} et on et.track_id = t.track_id and et.tenant_id = t.tenant_id
      join {{environments}} e on e.environment_id = et.environment_id and e.tenant_id = et.tenant_id and e.is_available
      join {{x_first_group}} fg on fg.user_id = r.user_id and fg.tenant_id = r.tenant_id and fg.environment_id = e.environment_id
      left join {{x_latest}} a on a.user_id = r.user_id and a.tenant_id = r.tenant_id and a.module_id = m.module_id
      left join {{exemptions}} x on x.user_id = r.user_id and x.tenant_id = r.tenant_id and x.module_id = m.module_id
      where r.entity_type = 'RD' and r.role_id in (1, 2)
        and exists (select 1 from {{x_users_any}} v where v.entity_id = r.user_id and v.tenant_id = r.tenant_id)
        and exists (select 1 from {{x_envs_any}} v where v.entity_id = e.environment_id and v.tenant_id = e.tenant_id)) z"""
BLOCKS["x_cell_text"] = f"""
    select *, case when not is_active or "window" = 'null' then status_text when is_done then {comma("cast(total_score as decimal(10,2))")}
                   when first_access_at is not null then 'Em andamento' else 'Nunca acessou' end as cell from {{x_cells}}"""
BLOCKS["x_environment_totals"] = f"""
    select *, case when exempt_rows = module_rows then 'exempted' when modules_done >= module_rows then 'finished'
                   when last_end < {NOW} then 'expired' when modules_started > 0 then 'in_progress'
                   when last_start > {NOW} then 'not_released' else 'not_started' end as environment_status
    from (
      select user_id, tenant_id, environment_id, count(*) as module_rows, count(case when is_done then 1 end) as modules_done,
             count(case when is_approved then 1 end) as modules_approved, count(case when status_id <> 'nao_iniciado' then 1 end) as modules_started,
             count(case when starts_at <= {NOW} then 1 end) as modules_open, count(case when is_exempt then 1 end) as exempt_rows,
             count(distinct track_id) as total_tracks, count(distinct case when status_id <> 'nao_iniciado' then track_id end) as started_tracks,
             count(distinct track_id) - count(distinct case when not is_done then track_id end) as finished_tracks,
             max(case when is_exempt then exempt_start else starts_at end) as last_start, max(case when is_exempt then exempt_end else ends_at end) as last_end
      from {{x_cells}} group by user_id, tenant_id, environment_id) g"""

BLOCKS["x_track_link"] = """
    select user_id, tenant_id, track_id, max(role_id) as role_id, min(created_at) as linked_at,
           max(case when rn = 1 then coalesce(origin_created, origin_updated) end) as origin, max(case when rn = 1 then coalesce(created_by, updated_by) end) as creator
    from (select r.*, m.track_id, row_number() over (partition by r.user_id, r.tenant_id, m.track_id order by r.created_at, m.module_id,
                   coalesce(r.origin_created, r.origin_updated), coalesce(r.created_by, r.updated_by)) as rn
          from {roles} r join {modules} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id and m.is_active
          where r.entity_type = 'RD' and r.role_id in (1, 2, 3)) x group by user_id, tenant_id, track_id"""
BLOCKS["x_track_facts"] = f"""
    select *, case when exempt_modules >= total_modules then 'exempted'
        when approved_modules + failed_modules >= total_modules - exempt_modules then
          case when recertification_id is not null and ((for_mandatory and role_id = 1) or (for_participant and role_id = 2)) and {NOW} <= expires_at then 'valid_certification'
               when recertification_id is not null and {NOW} > expires_at then 'invalid_certification' else 'finished' end
        when expired_modules + late_modules > 0 and in_progress_modules + not_started_modules + awaiting_modules = 0 then 'expired'
        when not_released_modules > 0 and not_released_modules >= total_modules - exempt_modules then 'not_released'
        when not_started_modules > 0 and approved_modules + failed_modules + awaiting_modules + in_progress_modules + expired_modules + late_modules = 0 then 'not_started'
        when in_progress_modules + awaiting_modules + not_started_modules > 0 then 'in_progress' else 'not_started' end as track_status,
      total_modules - exempt_modules as required_modules, exempt_modules >= total_modules as is_exempt,
      case when coalesce(recertification_attempt_id, 0) = 0 then 'default' else 'recertification' end as attempt_type
    from (
      select pr.*, li.role_id, li.linked_at, li.origin, rc.recertification_id, rc.for_mandatory, rc.for_participant,
             pr.finished_at + interval '1' day * rc.expiry_days as expires_at,
             row_number() over (partition by pr.user_id, pr.tenant_id, pr.track_id order by pr.progress_id) as rn
      from {{track_progress}} pr join {{users}} u on u.user_id = pr.user_id and u.tenant_id = pr.tenant_id and {REAL}
      join {{x_track_link}} li on li.user_id = pr.user_id and li.tenant_id = pr.tenant_id and li.track_id = pr.track_id
      left join {{recertifications}} rc on rc.track_id = pr.track_id and rc.tenant_id = pr.tenant_id and rc.is_active
      where exists (select 1 from {{modules}} m where m.track_id = pr.track_id and m.tenant_id = pr.tenant_id and m.is_active)
        and exists (select 1 from {{x_users_any}} v where v.entity_id = pr.user_id and v.tenant_id = pr.tenant_id)
        and exists (select 1 from {{x_envs_any}} v where v.entity_id = pr.environment_id and v.tenant_id = pr.tenant_id)) z where rn = 1"""

BLOCKS["x_plan"] = """
    select distinct gm.user_id, et.tenant_id, et.environment_id, et.track_id
    from {environment_tracks} et join {environment_groups} eg on eg.environment_id = et.environment_id and eg.tenant_id = et.tenant_id
    join {environments} e on e.environment_id = et.environment_id and e.tenant_id = et.tenant_id and e.is_available
    join {group_members} gm on gm.group_id = eg.group_id and gm.tenant_id = eg.tenant_id
    join {tracks} t on t.track_id = et.track_id and t.tenant_id = et.tenant_id and t.is_active and t.is_visible
    where exists (select 1 from {modules} m join {roles} r on r.entity_id = m.module_id and r.tenant_id = m.tenant_id and r.entity_type = 'RD' and r.role_id in (1, 2, 3)
                  where m.is_active and m.track_id = et.track_id and m.tenant_id = et.tenant_id and r.user_id = gm.user_id)"""


def summary(plan: str) -> str:
    def half(source: str, started: str) -> str:
        return f"""
            select p.user_id, p.tenant_id, p.environment_id, p.track_id, a.updated_at as attempt_updated_at, coalesce(m.workload_minutes, 0) as summed_workload,
                   min({started}) as started_at, max(a.updated_at) as completed_at, count(m.module_id) as modules, count(a.attempt_id) as modules_started,
                   count(case when a.status_id = 'aguardando_correcao' or a.is_done then 1 end) as modules_done, count(case when a.is_approved then 1 end) as modules_approved,
                   cast(coalesce(sum(case when a.status_id = 'aguardando_correcao' or a.is_done then coalesce(a.points, 0) + coalesce(a.challenge_bonus, 0)
                     + case when m.allows_time_bonus then coalesce(a.time_bonus, 0) else 0 end end), 0) as decimal(18,2)) as score,
                   cast(sum(case when coalesce(m.workload_minutes, 0) > 0 then case when a.is_done then m.workload_minutes * 60 end else a.access_seconds end) as bigint) as spent_seconds,
                   count(case when m.starts_at > {NOW} then 1 end) as modules_not_released
            from {plan} p {source}
            left join {{x_latest}} a on a.user_id = p.user_id and a.tenant_id = p.tenant_id and a.module_id = m.module_id
            group by p.user_id, p.tenant_id, p.environment_id, p.track_id, a.updated_at, coalesce(m.workload_minutes, 0)"""

    own = half("join {modules} m on m.track_id = p.track_id and m.tenant_id = p.tenant_id and m.is_active and m.is_visible", "a.created_at")
    far = half(
        """join {module_links} k on k.track_id = p.track_id and k.tenant_id = p.tenant_id and k.kind = 'round' and k.is_active
           join {modules} m on m.module_id = k.target_module_id and m.tenant_id = k.tenant_id and m.is_active and m.is_visible""", "k.created_at")
    return f"{own} union {far}"


def rollup(summaries: str) -> str:
    return f"""
        select user_id, tenant_id, environment_id, count(track_id) as total_tracks, count(case when modules_started > 0 then 1 end) as started_tracks,
               count(case when modules > 0 and modules_done >= modules then 1 end) as finished_tracks,
               count(case when modules > 0 and modules_approved >= modules then 1 end) as approved_tracks,
               count(case when modules > 0 and modules_not_released >= modules then 1 end) as not_released_tracks,
               cast(sum(score) as decimal(18,2)) as score, min(started_at) as started_at, max(completed_at) as completed_at,
               cast(sum(case when workload > 0 then workload * 60 else coalesce(spent, 0) end) as bigint) as time_seconds,
               count(case when modules_started > 0 then 1 end) > 0 as has_started,
               count(case when modules > 0 and modules_done >= modules then 1 end) >= count(track_id) as has_finished
        from (select user_id, tenant_id, environment_id, track_id, sum(modules) as modules, sum(modules_done) as modules_done, sum(modules_approved) as modules_approved,
                     sum(modules_started) as modules_started, sum(modules_not_released) as modules_not_released, sum(score) as score, min(started_at) as started_at,
                     max(completed_at) as completed_at, sum(spent_seconds) as spent, sum(summed_workload) as workload
              from {summaries} group by user_id, tenant_id, environment_id, track_id) t
        group by user_id, tenant_id, environment_id"""


BLOCKS["x_summary"] = summary("{x_plan}")
BLOCKS["x_rollup"] = rollup("{x_summary}")
BLOCKS["x_exempt"] = """
    select u.user_id, u.tenant_id, e.environment_id
    from (select distinct user_id, tenant_id from {exemptions}) u join {environments} e on e.tenant_id = u.tenant_id
    join {environment_tracks} et on et.environment_id = e.environment_id and et.tenant_id = e.tenant_id
    join {tracks} t on t.track_id = et.track_id and t.tenant_id = et.tenant_id and t.is_active
    join {modules} m on m.track_id = t.track_id and m.tenant_id = t.tenant_id and m.is_active
    left join {exemptions} x on x.module_id = m.module_id and x.tenant_id = m.tenant_id and x.user_id = u.user_id and x.starts_at is null and x.ends_at is null
    group by u.user_id, u.tenant_id, e.environment_id having count(x.module_id) = count(*)"""


def environment_facts(name: str, users: str, envs: str, user_filter: str, roles_in: str) -> None:
    """Registers blocks ``<name>_plan``, ``_summary``, ``_rollup`` and ``<name>``."""
    BLOCKS[f"{name}_plan"] = f"""
        select p.* from {{x_plan}} p join {{users}} u on u.user_id = p.user_id and u.tenant_id = p.tenant_id and {REAL} and {user_filter}
        where exists (select 1 from {{{users}}} v where v.entity_id = p.user_id and v.tenant_id = p.tenant_id)
          and exists (select 1 from {{{envs}}} v where v.entity_id = p.environment_id and v.tenant_id = p.tenant_id)
          and exists (select 1 from {{modules}} m join {{roles}} r on r.entity_id = m.module_id and r.tenant_id = m.tenant_id and r.entity_type = 'RD' and r.role_id in {roles_in}
                      where m.is_active and m.track_id = p.track_id and m.tenant_id = p.tenant_id and r.user_id = p.user_id)"""
    BLOCKS[f"{name}_summary"] = summary(f"{{{name}_plan}}")
    BLOCKS[f"{name}_rollup"] = rollup(f"{{{name}_summary}}")
    BLOCKS[name] = f"""
        select *, case when exempt_modules >= total_modules or is_exempt then 'exempted'
            when approved_modules + failed_modules >= available_modules then 'finished'
            when expired_modules + late_modules > 0 and in_progress_modules + not_started_modules + awaiting_modules = 0 then 'expired'
            when (not_released_modules >= 0 and not_released_modules >= available_modules) or not_released_tracks >= total_tracks then 'not_released'
            when not_started_modules > 0 and approved_modules + failed_modules + awaiting_modules + in_progress_modules + expired_modules + late_modules = 0 then 'not_started'
            when in_progress_modules + awaiting_modules + not_started_modules > 0 then 'in_progress' else 'not_started' end as environment_status,
          case when has_started then started_at end as shown_start
        from (
          select r.*, coalesce(ea.last_access_at, r.completed_at) as last_seen_at, x.user_id is not null as is_exempt, c.*
          from {{{name}_rollup}} r
          left join {{entity_access}} ea on ea.user_id = r.user_id and ea.tenant_id = r.tenant_id and ea.entity_id = r.environment_id and ea.entity_type = 'CP'
          left join {{x_exempt}} x on x.user_id = r.user_id and x.tenant_id = r.tenant_id and x.environment_id = r.environment_id
          left join lateral (
            select cast(sum(approved_modules) as bigint) as approved_modules, sum(failed_modules) as failed_modules, sum(in_progress_modules) as in_progress_modules,
                   sum(not_started_modules) as not_started_modules, sum(not_released_modules) as not_released_modules, sum(finished_modules) as finished_modules,
                   sum(expired_modules) as expired_modules, sum(late_modules) as late_modules, sum(exempt_modules) as exempt_modules, sum(awaiting_modules) as awaiting_modules,
                   cast(sum(total_modules - exempt_modules) as bigint) as available_modules, sum(total_modules) as total_modules
            from {{track_progress}} q
            where q.user_id = r.user_id and q.tenant_id = r.tenant_id and q.environment_id = r.environment_id
              and exists (select 1 from {{tracks}} t where t.track_id = q.track_id and t.tenant_id = q.tenant_id and t.is_active and t.is_visible)
              and exists (select 1 from {{modules}} m where m.track_id = q.track_id and m.tenant_id = q.tenant_id and m.is_active and m.is_visible)
              and exists (select 1 from {{{name}_plan}} p where p.track_id = q.track_id and p.tenant_id = q.tenant_id and p.user_id = q.user_id and p.environment_id = q.environment_id)
          ) c on true) z"""
    BLOCKS[f"{name}_link"] = f"""
        select * from (
          select r.user_id, r.tenant_id, et.environment_id, r.role_id, r.created_at as linked_at, r.origin_created, coalesce(r.origin_created, r.origin_updated) as origin,
                 coalesce(r.created_by, r.updated_by) as creator,
                 row_number() over (partition by r.user_id, r.tenant_id, et.environment_id order by r.role_id, r.created_at, m.module_id) as rn
          from {{roles}} r join {{modules}} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id
          join {{environment_tracks}} et on et.track_id = m.track_id and et.tenant_id = m.tenant_id
          where r.entity_type = 'RD' and r.role_id in {roles_in}) x where rn = 1"""
    BLOCKS[f"{name}_linked"] = f"""
        select l.*, case when l.origin = 1 then coalesce(vu.full_name, l.creator) when l.origin = 2 then coalesce(pa.name, l.creator)
                         when l.origin = 3 then l.creator when l.origin = 4 then coalesce(ua.full_name, l.creator) end as linked_by
        from {{{name}_link}} l
        left join {{users}} vu on vu.user_id = try_cast(l.creator as bigint) and vu.tenant_id = l.tenant_id and l.origin = 1
        left join {{audiences}} pa on pa.audience_id = try_cast(l.creator as bigint) and pa.tenant_id = l.tenant_id and l.origin = 2
        left join {{imports}} im on im.import_id = try_cast(l.creator as bigint) and im.tenant_id = l.tenant_id and l.origin = 4
        left join {{users}} ua on ua.user_id = im.admin_id and ua.tenant_id = im.tenant_id"""


environment_facts("x_env", "x_users_any", "x_envs_any", "true", "(1, 2, 3)")
environment_facts("x_env12", "x_users_any", "x_envs_any", "u.is_active", "(1, 2)")
environment_facts("x_envtree", "x_users_tree", "x_envs_tree", "true", "(1, 2, 3)")

_ENV_LABEL = """case environment_status when 'finished' then 'Concluído' when 'expired' then 'Expirado (Não concluído)' when 'in_progress' then 'Em andamento'
    when 'not_started' then 'Não iniciado' when 'not_released' then 'Não liberado' when 'exempted' then 'Dispensado' end"""
_ATTR_COLUMNS = ", ".join(f"wa.{a}" for a in _ATTRIBUTES)


def attributes_of(alias: str) -> str:
    return f"left join {{x_wide_attributes}} wa on wa.user_id = {alias}.user_id and wa.tenant_id = {alias}.tenant_id"


# ---- audiences: each criterion as a set of (user_id, tenant_id) ------------------------------------------------


def people(condition: str, active: bool = True) -> str:
    return f"select u.user_id, u.tenant_id from {{users}} u where {REAL} {'and u.is_active' if active else ''} and {condition}"


def in_environments(ids: str) -> str:
    return people(f"""exists (select 1 from {{environments}} e join {{environment_groups}} eg on eg.environment_id = e.environment_id and eg.tenant_id = e.tenant_id
        join {{group_members}} gm on gm.group_id = eg.group_id and gm.tenant_id = eg.tenant_id
        where e.is_available and e.environment_id in {ids} and gm.user_id = u.user_id and gm.tenant_id = u.tenant_id)""")


def in_tracks(ids: str) -> str:
    return people(f"""exists (
        select 1 from {{tracks}} t join {{environment_tracks}} et on et.track_id = t.track_id and et.tenant_id = t.tenant_id
        join {{environment_groups}} eg on eg.environment_id = et.environment_id and eg.tenant_id = et.tenant_id
        join {{group_members}} gm on gm.group_id = eg.group_id and gm.tenant_id = eg.tenant_id
        where t.is_active and t.track_id in {ids} and gm.user_id = u.user_id and gm.tenant_id = u.tenant_id and (
          exists (select 1 from {{roles}} r join {{modules}} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id
                  where r.entity_type = 'RD' and r.role_id in (1, 2, 3) and m.track_id = t.track_id and r.user_id = u.user_id and r.tenant_id = u.tenant_id)
          or exists (select 1 from {{roles}} r where r.entity_type = 'TR' and r.role_id in (1, 2, 3) and r.entity_id = t.track_id and r.user_id = u.user_id and r.tenant_id = u.tenant_id)
          or exists (select 1 from {{roles}} r join {{module_links}} k on k.link_id = r.entity_id and k.tenant_id = r.tenant_id
                     where r.entity_type = 'RL' and r.role_id in (1, 2, 3) and k.track_id = t.track_id and r.user_id = u.user_id and r.tenant_id = u.tenant_id)))""")


def progress(key: str, value: int, test: str) -> str:
    return people(f"""exists (select 1 from (select sum(total_modules) as a, sum(finished_modules) as d from {{track_progress}} q
        where q.user_id = u.user_id and q.tenant_id = u.tenant_id and q.{key} = {value} group by q.user_id) g where {test})""")


FINISHED, UNFINISHED = "a = d and a > 0", "not (a = d and a > 0)"


def attribute(attribute_id: int, test: str) -> str:
    return people(f"""exists (select 1 from {{entity_attributes}} e join {{attributes}} a on a.attribute_id = e.attribute_id and a.tenant_id = e.tenant_id and a.is_active
        where e.entity_type = 'US' and e.entity_id = u.user_id and e.tenant_id = u.tenant_id and e.attribute_id = {attribute_id} and {test})""")


_NOT_SEEN = "not exists (select 1 from {{track_progress}} q where q.user_id = u.user_id and q.tenant_id = u.tenant_id and q.{key} = {value})"
AUDIENCES = {
    "competition": in_environments("(2, 4)"),
    "competition_not_participate": people(_NOT_SEEN.format(key="environment_id", value=1)),
    "competition_not_participate_any": people("not exists (select 1 from {roles} r where r.user_id = u.user_id and r.tenant_id = u.tenant_id and r.role_id in (1, 2, 3))"),
    "competition_finished": progress("environment_id", 2, FINISHED),
    "competition_not_finished": progress("environment_id", 3, UNFINISHED),
    "track": in_tracks("(1998, 1999)"),
    "track_not_participate": people(_NOT_SEEN.format(key="track_id", value=1996)),
    "track_finished": progress("track_id", 1997, FINISHED),
    "track_not_finished": progress("track_id", 1997, UNFINISHED),
    "group": people("exists (select 1 from {group_members} g where g.user_id = u.user_id and g.tenant_id = u.tenant_id and g.group_id in (103, 3))"),
    "user_profile": people("exists (select 1 from {roles} r where r.user_id = u.user_id and r.tenant_id = u.tenant_id and r.role_id = 3)"),
    "admin_profile": people("exists (select 1 from {profile_users} r where r.user_id = u.user_id and r.tenant_id = u.tenant_id and r.profile_id = 1)"),
    "user_status": people("not u.is_active", active=False),
    "select": attribute(4, "e.value_id = 2"),
    "multiple": attribute(7, "e.value_id in (2, 5)"),
    "integer": attribute(1, "try_cast(e.text_value as int) >= 100"),
    "date": attribute(5, "try_cast(e.text_value as date) between date '2024-01-10' and date '2024-01-12'"),
    "text": attribute(2, "strip_accents(lower(e.text_value)) like '%code-1%'"),
    "text_empty": people("""(not exists (select 1 from {entity_attributes} e where e.entity_type = 'US' and e.entity_id = u.user_id and e.tenant_id = u.tenant_id and e.attribute_id = 2)
        or exists (select 1 from {entity_attributes} e where e.entity_type = 'US' and e.entity_id = u.user_id and e.tenant_id = u.tenant_id and e.attribute_id = 2
                   and (e.text_value is null or e.text_value = '')))"""),
}

_ACTIVITY_LABEL = """case f.activity_status when 'finished' then 'Concluído' when 'expired' then 'Expirado' when 'awaiting_approval' then 'Aguardando Correção'
    when 'in_progress' then 'Em Andamento' when 'not_started' then 'Não Iniciado' when 'not_released' then 'Não Liberado' when 'exempted' then 'Dispensado' end"""


def activity_rows(users: str, envs: str, groups: str, condition: str) -> str:
    return f"""
        select f.tenant_id, f.user_id, f.full_name, f.email, f.login, f.user_status, f.parent_group_id, f.parent_group_name, f.child_group_id, f.child_group_name,
               ag.all_groups, f.environment_id, f.environment_name, f.track_id, f.track_name, f.module_id, f.module_name, f.activity_id, f.activity_name, f.attempt_id,
               f.activity_workload, f.activity_type, f.access_time, coalesce({minute("f.first_access_at")}, '') as first_access_at,
               coalesce({minute("f.last_access_at")}, '') as last_access_at, coalesce({minute("f.answered_at")}, '') as answered_at, f.hit_percent, f.statement, f.answer_text,
               f.activity_weight, f.feedback, {_ACTIVITY_LABEL} as activity_status, f.role_label, '' as accessed_meeting, {_ATTR_COLUMNS}
        from {{x_gold}} f {groups} {attributes_of("f")}
        where exists (select 1 from {{{users}}} v where v.entity_id = f.user_id and v.tenant_id = f.tenant_id)
          and exists (select 1 from {{{envs}}} v where v.entity_id = f.environment_id and v.tenant_id = f.tenant_id)
          and exists (select 1 from {{roles}} r where r.user_id = f.user_id and r.tenant_id = f.tenant_id and r.entity_type = 'RD' and r.role_id in (1, 2))
          and f.environment_active and f.activity_active and {condition}"""


_SETTINGS = """s.group_label, s.order_number, s.help_label, s.group_order, s.config_order, s.config_group_order, s.config_tab, s.config_group"""
_COLUMN_ORDER = sorted(MODULES_ACTIVE, key=lambda m: (6 - m[1], str(m[0] * 10 + m[1])))
_MODULE_COLUMNS = ", ".join(
    f"max(case when module_id = {y * 10 + p} then cell end) as \"{p}.Track {y} - Module {p} of {y}\"" for y, p in _COLUMN_ORDER
)
_GRADED = "q.module_status in ('approved', 'reproved', 'out_of_date')"


def graded(name: str) -> str:
    return f"cast(coalesce(q.{name}, 0) as decimal(10,2))"


# What each code of a filter is called.
_CONVERTED = """
    ('activity_status', 'awaiting_approval', 'Aguardando Correção'), ('activity_status', 'exempted', 'Dispensado'), ('activity_status', 'expired', 'Expirado'), ('activity_status', 'finished', 'Concluído'), ('activity_status', 'in_progress', 'Em Andamento'), ('activity_status', 'not_released', 'Não Liberado'), ('activity_status', 'not_started', 'Não Iniciado'),
    ('attempt_type', 'default', 'Padrão'), ('attempt_type', 'recertification', 'Recertificação'),
    ('environment_status', 'exempted', 'Dispensado'), ('environment_status', 'expired', 'Expirado (Não concluído)'), ('environment_status', 'finished', 'Concluído'), ('environment_status', 'in_progress', 'Em andamento'), ('environment_status', 'not_released', 'Não liberado'), ('environment_status', 'not_started', 'Não iniciado'),
    ('module_status', 'approved', 'Aprovado'), ('module_status', 'awaiting_approval', 'Aguardando Correção'), ('module_status', 'exempted', 'Dispensado'), ('module_status', 'expired', 'Expirado (Não Realizado)'), ('module_status', 'in_progress', 'Em Andamento'), ('module_status', 'invalid_certification', 'Certificação Inválida'), ('module_status', 'not_released', 'Não Liberado'), ('module_status', 'not_started', 'Não Iniciado'), ('module_status', 'out_of_date', 'Fora do Prazo'), ('module_status', 'reproved', 'Reprovado'), ('module_status', 'valid_certification', 'Certificação Válida'),
    ('notification_status', 'failed', 'Falha'), ('notification_status', 'sent', 'Enviado'), ('notification_status', 'summary', 'Rascunho'), ('notification_status', 'wating_for_sending', 'Aguardando envio'),
    ('question_status', 'answered', 'Respondida'), ('question_status', 'pending', 'Pendente'),
    ('role', '1', 'Obrigatório'), ('role', '2', 'Participa'), ('role', '3', 'Gestor'),
    ('track_status', 'exempted', 'Dispensado'), ('track_status', 'expired', 'Expirado (Não Concluído)'), ('track_status', 'finished', 'Concluído'), ('track_status', 'in_progress', 'Em Andamento'), ('track_status', 'invalid_certification', 'Certificação Inválida'), ('track_status', 'not_released', 'Não Liberado'), ('track_status', 'not_started', 'Não Iniciado'), ('track_status', 'valid_certification', 'Certificação Válida'),
    ('user_status', '1', 'Ativo'), ('user_status', '2', 'Inativo')
"""


_CHECKS: dict[str, str] = {
    "status_by_track": """
        select m.tenant_id, m.track_id, a.status_id, count(*) as attempts, count(case when a.is_done then 1 end) as done, count(case when a.is_approved then 1 end) as approved,
               cast(sum(a.total_score) as decimal(18,2)) as score
        from {x_latest} a join {modules} m on m.module_id = a.module_id and m.tenant_id = a.tenant_id group by m.tenant_id, m.track_id, a.status_id""",
    "latest_attempt": "select user_id, tenant_id, module_id, attempt_id, status_id, cast(total_score as decimal(18,2)) as total_score, is_done, is_approved from {x_latest}",
    "attempt_history_numbered": """
        select user_id, tenant_id, module_id, attempt_id, attempt_number,
               cast(coalesce(points, 0) + coalesce(challenge_bonus, 0) + coalesce(time_bonus, 0) as decimal(18,2)) as total_score
        from {x_numbered}""",
    "attempt_history_of_busy_users": """
        select user_id % 3 as user_id, tenant_id, module_id, attempt_id, row_number() over (partition by user_id % 3, tenant_id, module_id order by attempt_id) as attempt_number
        from {attempts} where status_id <> 'cancelado'""",
    "activity_role_filters": """
        select 'none' as roles, count(*) as n from {x_gold} where environment_active and track_active and module_active and activity_active
        union all select 'unknown', 0
        union all select 'one known', count(*) from {x_gold} where environment_active and track_active and module_active and activity_active and role_label = 'Obrigatório'""",
    "activity_status_filters": """
        select 'none' as statuses, count(*) as n from {x_gold} where environment_active and track_active and module_active and activity_active
        union all select 'unknown', 0
        union all select 'one known', count(*) from {x_gold} where environment_active and track_active and module_active and activity_active and user_status = 'Inativo'
        union all select 'both', count(*) from {x_gold} where environment_active and track_active and module_active and activity_active""",
    "activity_of_listed_modules": """
        select tenant_id, module_id, child_group_id, parent_group_id, count(*) as n from {x_gold}
        where environment_active and track_active and activity_active and module_id between 17984 and 19983
          and (child_group_id between 104 and 1203 or parent_group_id between 104 and 1203)
        group by all""",
    "first_group": "select * from {x_first_group}",
    "first_group_any_environment": "select * from {x_any_group}",
    "all_groups": "select * from {x_all_groups}",
    "all_groups_filtered": groups_text("m.group_id in (1, 2, 105, 106, 107)"),
    "label_override": label(f"select distinct l.label_id, t.tenant_id from {{labels}} l cross join (select unnest([{_EACH_TENANT}]) as tenant_id) t", "pt"),
    "settings_overlay": f"""
        select s.setting_id, t.tenant_id, s.description, coalesce(o.file, s.file) as file, coalesce(o.is_active, s.is_active) as is_active,
               coalesce(o.is_visible, s.is_visible) as is_visible, o.setting_id is null as is_default, '' as tenant_theme, {_SETTINGS}
        from {{settings}} s cross join (select distinct tenant_id from {{users}}) t
        left join {{tenant_settings}} o on o.setting_id = s.setting_id and o.tenant_id = t.tenant_id""",
    "environment_settings_overlay": f"""
        select s.setting_id, e.tenant_id, e.environment_id, s.description, coalesce(o.file, s.file) as file, coalesce(o.is_active, s.is_active) as is_active,
               coalesce(o.is_visible, s.is_visible) as is_visible, o.setting_id is null as is_default, {_SETTINGS}
        from {{environment_settings}} s cross join {{environments}} e
        left join {{tenant_environment_settings}} o on o.setting_id = s.setting_id and o.tenant_id = e.tenant_id and o.environment_id = e.environment_id""",
    "partial_score_switch": "select tenant_id, environment_id, is_on from {x_partial}",
    "attributes_latest": "select * from {x_attributes}",
    "attributes_pivot": "select * from {x_wide_attributes}",
    "attribute_names_by_tenant": """
        select tenant_id, trim(replace(name, tenant_id || '_', '')) as attribute, min(attribute_id) as first_id from {attributes} where is_active group by all""",
    "attributes_of_two_tenants": f"""
        select u.user_id, u.tenant_id, {_ATTR_COLUMNS} from {{users}} u left join {{x_wide_attributes}} wa on wa.user_id = u.user_id and wa.tenant_id = u.tenant_id
        where u.tenant_id in ({", ".join(f"'{t}'" for t in TENANTS[:2])})""",
    "module_pivot": "select user_id, tenant_id, "
    + ", ".join(f"cast(max(case when module_id = {y * 10 + p} then total_score end) as decimal(18,2)) as module_{y * 10 + p}" for y in range(1995, 2002) for p in range(1, 6))
    + " from {x_latest} group by user_id, tenant_id",
    "editable_any": "select * from {x_users_any}",
    "editable_tree": "select * from {x_users_tree}",
    "editable_specific": editable("{specific_admins}", "US"),
    "editable_environments": editable(EVERY_ADMIN, "CP"),
    "editable_activities": editable(EVERY_ADMIN, "AT"),
    "editable_achievements": editable(EVERY_ADMIN, "CQ"),
    "editable_ungrouped": f"select * from ({editable(EVERY_ADMIN, 'US')}) x where not is_linked",
    "hierarchy_distinct": "select * from {x_hierarchy}",
    "hierarchy_active": """select * from {x_hierarchy} where activity_active and module_active and track_active and environment_active
        and activity_type_id in ('formulario', 'minigame', 'padrao_sou') and track_id in (1996, 1997, 1998, 1999, 2000)""",
    "user_plan": f"""
        select r.user_id, r.tenant_id, m.module_id, m.track_id, m.name as module_name, r.role_id, u.full_name, u.is_active, {role("r.role_id")} as role_label
        from {{roles}} r join {{users}} u on u.user_id = r.user_id and u.tenant_id = r.tenant_id and {REAL}
        join {{modules}} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id where r.entity_type = 'RD' and r.role_id in (1, 2, 3)""",
    "answers_concat": """
        select coalesce(c.attempt_id, f.attempt_id) as attempt_id, coalesce(c.activity_id, f.activity_id) as activity_id, coalesce(c.tenant_id, f.tenant_id) as tenant_id,
               c.choice_text, f.form_text
        from {x_choice} c full join {x_form} f on f.attempt_id = c.attempt_id and f.activity_id = c.activity_id and f.tenant_id = c.tenant_id""",
    "answers_minigame": "select * from {x_game}",
    "answer_choice": "select user_id, tenant_id, environment_id, activity_id, activity_type_id, answer_text from {x_facts}",
    "activity_status": """select tenant_id, track_id, environment_id, activity_type_id, activity_status, count(*) as rows, count(attempt_id) as with_attempt
        from {x_facts} group by tenant_id, track_id, environment_id, activity_type_id, activity_status""",
    "weight_override": "select user_id, tenant_id, environment_id, activity_id, activity_weight, activity_workload from {x_facts}",
    "activity_gold": "select * from {x_gold}",
    "activity_report": activity_rows(
        "x_users_any", "x_envs_any", "left join {x_all_groups} ag on ag.user_id = f.user_id and ag.tenant_id = f.tenant_id",
        "f.track_active and f.module_active and f.user_status = 'Ativo' and f.role_label in ('Obrigatório', 'Participa')"),
    "activity_report_filtered": activity_rows(
        "x_users_tree", "x_envs_tree",
        f"join ({groups_text('m.group_id in (1, 2, 3, 104, 105)')}) ag on ag.user_id = f.user_id and ag.tenant_id = f.tenant_id",
        """f.activity_status in ('in_progress', 'expired', 'not_started') and (f.child_group_id in (1, 2, 3, 104, 105) or f.parent_group_id in (1, 2, 3, 104, 105))
           and (f.first_access_at between timestamp '1997-01-01 00:00:00' and timestamp '2000-12-31 00:00:00' or f.first_access_at is null)"""),
    "module_window_status": f"""
        select r.user_id, r.tenant_id, m.module_id, {MODULE_WINDOW} as "window"
        from {{roles}} r join {{modules}} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id
        left join {{exemptions}} x on x.module_id = m.module_id and x.user_id = r.user_id and x.tenant_id = r.tenant_id
        where r.entity_type = 'RD' and r.role_id in (1, 2, 3)""",
    "module_status_rows": f"""
        select q.tenant_id, q.user_id, q.full_name, q.email, q.login, case when q.is_active then 'Ativo' else 'Inativo' end as user_status, q.parent_group_id,
               q.parent_group_name, q.child_group_id, q.child_group_name, ag.all_groups, q.environment_id, q.environment_name, q.track_id, q.track_name, q.module_id,
               q.module_name, q.attempt_id, {role("q.role_id", "''")} as role_label,
               case when q.workload_minutes is not null then {clock("q.workload_minutes * 60")} end as module_workload,
               {minute("q.first_access_at")} as started_at, {minute("q.completed_at")} as completed_at,
               case when {_GRADED} then {comma(graded("points"))} else '' end as points,
               case when {_GRADED} then cast({graded("challenge_bonus")} as varchar) else '' end as challenge_bonus,
               case when {_GRADED} then {comma(graded("time_bonus"))} else '' end as time_bonus,
               case when {_GRADED} then {comma("cast(coalesce(q.points, 0) + coalesce(q.challenge_bonus, 0) + coalesce(q.time_bonus, 0) as decimal(10,2))")} else '' end as total_score,
               case q.module_status when 'approved' then 'Aprovado' when 'reproved' then 'Reprovado' when 'out_of_date' then 'Fora do Prazo'
                    when 'expired' then 'Expirado (Não Realizado)' when 'awaiting_approval' then 'Aguardando Correção' when 'in_progress' then 'Em Andamento'
                    when 'not_started' then 'Não Iniciado' when 'not_released' then 'Não Liberado' when 'exempted' then 'Dispensado' else 'Concluido' end as module_status,
               {clock("coalesce(q.access_seconds, 0)")} as access_time,
               case q.module_status when 'out_of_date' then 'Fora do Prazo' when 'approved' then 'Dentro do Prazo' when 'reproved' then 'Dentro do Prazo'
                    when 'not_started' then '' when 'in_progress' then '' end as done_on_time,
               {minute("q.module_created_at")} as module_created_at, {minute("q.module_updated_at")} as module_updated_at, q.updated_by, q.attempt_number,
               {minute("q.linked_at")} as linked_at, {origin("q.origin_created")} as link_origin, q.linked_by, q.track_modules, q.track_modules_done,
               {minute("q.last_completed_at")} as last_completed_at, {_ATTR_COLUMNS}
        from {{x_module_rows}} q left join {{x_all_groups}} ag on ag.user_id = q.user_id and ag.tenant_id = q.tenant_id {attributes_of("q")}""",
    "module_status_rows_all_attempts": """
        select user_id, tenant_id, environment_id, module_id, attempt_id, attempt_number, role_id, "window", module_status, first_access_at, completed_at, track_modules,
               track_modules_done, last_completed_at from {x_module_attempts}""",
    "module_workload": "select * from {x_workload}",
    "module_status_columns": f"""
        select w.*, ag.all_groups, u.full_name, u.email, u.login, {ACTIVE} as user_status,
               case when t.environment_status = 'finished' then coalesce({comma("s.score")}, '') else '' end as environment_score,
               {_ENV_LABEL.replace("case environment_status", "case t.environment_status")} as environment_status, {_ATTR_COLUMNS}
        from (select tenant_id, user_id, parent_group_id, parent_group_name, child_group_id, child_group_name, {role("role_id")} as role_label, environment_name,
                     environment_id, {_MODULE_COLUMNS}
              from {{x_cell_text}} group by tenant_id, user_id, parent_group_id, parent_group_name, child_group_id, child_group_name, role_id, environment_name, environment_id) w
        join {{x_environment_totals}} t on t.user_id = w.user_id and t.tenant_id = w.tenant_id and t.environment_id = w.environment_id
        join {{users}} u on u.user_id = w.user_id and u.tenant_id = w.tenant_id
        left join {{environment_scores}} s on s.user_id = w.user_id and s.tenant_id = w.tenant_id and s.environment_id = w.environment_id and s.ranking_id = 0
        left join {{x_all_groups}} ag on ag.user_id = w.user_id and ag.tenant_id = w.tenant_id {attributes_of("w")}""",
    "module_columns_of_few_users": """
        select distinct c.tenant_id, c.module_id,
               cast(c.module_id % 10 as varchar) || '.Track ' || cast(c.module_id // 10 as varchar) || ' - Module ' || cast(c.module_id % 10 as varchar) || ' of ' || cast(c.module_id // 10 as varchar) as header
        from {x_cells} c join {x_environment_totals} t on t.user_id = c.user_id and t.tenant_id = c.tenant_id and t.environment_id = c.environment_id
        where c.user_id % 150 = 1 and c.user_id < 1500 and t.environment_status in ('in_progress', 'expired', 'finished')""",
    "module_column_cells": f"""
        select user_id, tenant_id, environment_id, module_id, module_index,
               cast(module_index as varchar) || '.' || substring(track_name || ' - ' || module_name, 1, 124) as module_label,
               case status_text when 'Disp/Inat' then 'exempted' when 'Aguardando Correção' then 'awaiting_approval' when 'Aprovado' then 'approved' when 'Reprovado' then 'reproved'
                    when 'Concluido' then 'finished' when 'Não Iniciado' then 'not_started' when 'Em Andamento' then 'in_progress' when 'Não Realizado' then 'not_done' end as module_status,
               cell, {second("finished_at")} as completed_at from {{x_cell_text}}""",
    "environment_status_from_modules": """
        select user_id, tenant_id, environment_id, module_rows, modules_done, modules_approved, modules_started, modules_open, total_tracks, finished_tracks, started_tracks,
               environment_status from {x_environment_totals}""",
    "track_link": "select * from {x_track_link}",
    "track_status": "select user_id, tenant_id, track_id, role_id, expires_at, track_status, attempt_type from {x_track_facts}",
    "track_report": f"""
        select f.tenant_id, f.user_id, u.full_name, u.email, u.login, {ACTIVE} as user_status, g.parent_group_id, g.parent_group_name, g.child_group_id, g.child_group_name,
               ag.all_groups, f.environment_id, e.name as environment_name, f.track_id, t.name as track_name, {role("f.role_id", "null")} as role_label,
               case when f.is_exempt then '' when f.workload_seconds > 0 then {short("f.workload_seconds")} end as track_workload,
               case when f.is_exempt or f.track_status = 'not_started' then null else {second("f.first_access_at")} end as started_at,
               case when f.is_exempt then '' when f.finished_modules >= f.required_modules then {second("f.finished_at")} end as completed_at,
               case when f.is_exempt then '' else cast(cast(trunc(f.score) as bigint) as varchar) end as track_score,
               case when f.is_exempt or f.track_status in ('not_started', 'not_released') then '' else {comma(share("f.finished_modules", "f.required_modules"))} || '%' end as completion_percent,
               case when f.is_exempt or f.required_modules = 0 then '' else {comma(share("f.approved_modules", "f.required_modules"))} || '%' end as approval_percent,
               case when f.is_exempt then '' when f.access_seconds > 0 then {short("f.access_seconds")} else '' end as access_time,
               case f.track_status when 'finished' then 'Concluído' when 'expired' then 'Expirado (Não Concluído)' when 'in_progress' then 'Em Andamento'
                    when 'not_started' then 'Não Iniciado' when 'not_released' then 'Não Liberado' when 'exempted' then 'Dispensado'
                    when 'invalid_certification' then 'Certificação Inválida' when 'valid_certification' then 'Certificação Válida' end as track_status,
               case when f.is_exempt or f.track_status in ('not_started', 'not_released') then 'Não' else 'Sim' end as has_started,
               case when f.is_exempt then 'Não' when f.finished_modules >= f.required_modules then 'Sim' else 'Não' end as has_completed,
               case when f.is_exempt then 'Não' when f.approved_modules >= f.required_modules then 'Sim' else '' end as is_approved,
               f.required_modules as modules_linked, f.finished_modules as modules_finished, f.approved_modules as modules_approved, {minute("f.linked_at")} as linked_at,
               {origin("f.origin")} as link_origin, case f.attempt_type when 'default' then 'Padrão' else 'Recertificação' end as attempt_type,
               (select string_agg(m.name, ', ' order by m.module_id) from {{modules}} m where m.track_id = f.track_id and m.tenant_id = f.tenant_id and m.is_active
                  and exists (select 1 from {{attempts}} a where a.user_id = f.user_id and a.tenant_id = m.tenant_id and a.module_id = m.module_id and a.status_id in {CLOSED})
                  and not exists (select 1 from {{exemptions}} x where x.user_id = f.user_id and x.tenant_id = m.tenant_id and x.module_id = m.module_id
                                  and x.starts_at is null and x.ends_at is null)) as finished_modules_text,
               case when f.attempt_type = 'default' then '' else {minute("f.expires_at")} end as expires_at,
               nullif(f.recertification_attempt_id, 0) as recertification_attempt_id, {_ATTR_COLUMNS}
        from {{x_track_facts}} f join {{users}} u on u.user_id = f.user_id and u.tenant_id = f.tenant_id and u.is_active
        join {{environments}} e on e.environment_id = f.environment_id and e.tenant_id = f.tenant_id and e.is_available
        join {{tracks}} t on t.track_id = f.track_id and t.tenant_id = f.tenant_id and t.is_active
        join {{x_any_group}} g on g.user_id = f.user_id and g.tenant_id = f.tenant_id
          and (g.child_group_id in (1, 2, 3, 101, 104, 106, 108) or g.parent_group_id in (1, 2, 3, 101, 104, 106, 108))
        left join ({groups_text("m.group_id in (1, 2, 3, 101, 104, 106, 108)")}) ag on ag.user_id = f.user_id and ag.tenant_id = f.tenant_id {attributes_of("f")}
        where f.role_id in (1, 2) and (f.finished_modules < f.required_modules
          or f.finished_at between timestamp '1995-06-01 00:00:00' and timestamp '2001-06-30 00:00:00')""",
    "recert_expiry": """
        select p.user_id, p.tenant_id, p.track_id, p.finished_at + interval '1' day * r.expiry_days as expires_at,
               p.finished_at + interval '1' day * r.expiry_days - interval '1' day * r.available_days as renewable_at
        from {track_progress} p join {recertifications} r on r.track_id = p.track_id and r.tenant_id = p.tenant_id""",
    "environment_plan": "select * from {x_plan}",
    "track_summary_union": """select user_id, tenant_id, environment_id, track_id, summed_workload, started_at, completed_at, modules, modules_started, modules_done,
        modules_approved, score, spent_seconds, modules_not_released from {x_summary}""",
    "environment_rollup": "select * from {x_rollup}",
    "environment_exempt": "select * from {x_exempt}",
    "environment_status": """select user_id, tenant_id, environment_id, total_tracks, not_released_tracks, approved_modules, available_modules, is_exempt, last_seen_at,
        environment_status from {x_env}""",
    "environment_report": f"""
        select f.tenant_id, f.user_id, u.full_name, coalesce(u.email, '') as email, u.login, {ACTIVE} as user_status, g.parent_group_id, g.parent_group_name, g.child_group_id,
               g.child_group_name, ag.all_groups, f.environment_id, e.name as environment_name,
               case when f.is_exempt or f.environment_status in ('not_released', 'not_started') then '' else {second("f.shown_start")} end as started_at,
               case when f.is_exempt then '' when f.has_finished then {second("f.completed_at")} end as completed_at,
               case when f.is_exempt then '' when f.environment_status in ('not_released', 'not_started') then '0.00' else cast(f.score as varchar) end as score,
               case when f.is_exempt then '' else {comma(share("f.finished_modules", "f.available_modules"))} || '%' end as completion_percent,
               case when f.is_exempt then '' else {comma(share("f.approved_modules", "f.available_modules"))} || '%' end as approval_percent,
               case when f.is_exempt then '' when f.environment_status in ('not_released', 'not_started') then '0:00:00' else {short("f.time_seconds")} end as access_time,
               case when f.is_exempt then 0 else f.total_tracks end as total_tracks, case when f.is_exempt then 0 else f.started_tracks end as started_tracks,
               case when f.is_exempt then 0 else f.finished_tracks end as finished_tracks, case when f.is_exempt then 0 else f.approved_tracks end as approved_tracks,
               strftime(f.last_seen_at, '%d/%m/%Y') as last_access_at,
               case when f.is_exempt then '' when f.environment_status in ('not_released', 'not_started') or not f.has_started then 'Não' else 'Sim' end as has_started,
               case when f.is_exempt then '' when f.has_finished and f.completed_at is not null then case when f.approved_modules >= f.available_modules then 'Sim' else 'Não' end
                    when f.shown_start is not null then '' end as is_approved,
               {_ENV_LABEL} as environment_status, {role("l.role_id")} as role_label, {second("l.linked_at")} as linked_at, {origin("l.origin_created")} as link_origin, l.linked_by,
               {_ATTR_COLUMNS}
        from {{x_env12}} f join {{users}} u on u.user_id = f.user_id and u.tenant_id = f.tenant_id
        join {{environments}} e on e.environment_id = f.environment_id and e.tenant_id = f.tenant_id
        join {{x_env12_linked}} l on l.user_id = f.user_id and l.tenant_id = f.tenant_id and l.environment_id = f.environment_id
        left join {{x_first_group}} g on g.user_id = f.user_id and g.tenant_id = f.tenant_id and g.environment_id = f.environment_id
        left join {{x_all_groups}} ag on ag.user_id = f.user_id and ag.tenant_id = f.tenant_id {attributes_of("f")}""",
    "environment_report_by_group": f"""
        select f.tenant_id, f.user_id, f.environment_id, g.child_group_id, g.child_group_name, g.parent_group_id, {_ENV_LABEL} as environment_status
        from {{x_env12}} f join {{users}} u on u.user_id = f.user_id and u.tenant_id = f.tenant_id
        join {{x_env12_linked}} l on l.user_id = f.user_id and l.tenant_id = f.tenant_id and l.environment_id = f.environment_id
        join {{x_listed_group}} g on g.user_id = f.user_id and g.tenant_id = f.tenant_id and g.environment_id = f.environment_id""",
    "environment_report_for_audience": f"""
        select f.user_id, f.tenant_id, f.environment_id, {_ENV_LABEL} as environment_status,
               case when f.is_exempt then '' when f.environment_status in ('not_released', 'not_started') then '0.00' else cast(f.score as varchar) end as score,
               case when f.is_exempt then '' else {comma(share("f.finished_modules", "f.available_modules"))} || '%' end as completion_percent, l.linked_by
        from {{x_envtree}} f join {{x_envtree_linked}} l on l.user_id = f.user_id and l.tenant_id = f.tenant_id and l.environment_id = f.environment_id
        where (f.last_seen_at between timestamp '1998-01-01 00:00:00' and timestamp '2001-12-31 00:00:00' or f.last_seen_at is null)
          and (f.user_id, f.tenant_id) in ({attribute(2, "strip_accents(lower(e.text_value)) like '%code-%'")})""",
    "provenance_names": f"select user_id, tenant_id, module_id, origin_created, created_by, linked_by, {origin('origin_created')} as link_origin from {{x_provenance}}",
    "audience_all_criteria": f"""
        {AUDIENCES["competition"]} intersect {AUDIENCES["track"]}
        intersect {attribute(1, "(try_cast(e.text_value as int) >= 100 or try_cast(e.text_value as int) < 20)")}
        intersect {attribute(4, "e.value_id in (2, 3)")} intersect {AUDIENCES["track_not_finished"]}
        except {people("u.user_id = 7")} except {AUDIENCES["admin_profile"]}
        except {people("exists (select 1 from {group_members} g where g.user_id = u.user_id and g.tenant_id = u.tenant_id and g.group_id = 102)")}""",
    "audience_page": f"""
        select *, count(*) over () as total_users from (
          select u.user_id, u.tenant_id, u.full_name as name, coalesce(u.email, '') as email, u.login, u.created_by, u.updated_by, {second("u.updated_at")} as updated_at,
                 {second("u.created_at")} as created_at, u.is_active
          from {{users}} u join ({AUDIENCES["competition"]} except {AUDIENCES["track_finished"]}) a on a.user_id = u.user_id and a.tenant_id = u.tenant_id
          where lower(u.full_name) like '%customer#0000%' or lower(u.login) like '%customer#0000%' or lower(u.email) like '%customer#0000%') x
        order by name, tenant_id, user_id limit 40 offset 5""",
    "deep_audience_page": f"""
        select *, count(*) over () as total_users from (
          select u.user_id, u.tenant_id, u.full_name as name, coalesce(u.email, '') as email, u.login, u.created_by, u.updated_by, {second("u.updated_at")} as updated_at,
                 {second("u.created_at")} as created_at, u.is_active
          from {{users}} u join ({AUDIENCES["competition"]} except {AUDIENCES["track_finished"]}) a on a.user_id = u.user_id and a.tenant_id = u.tenant_id) x
        order by name, tenant_id, user_id limit 45 offset 300""",
    "text_criteria": """
        select entity_attribute_id, attribute_id, lower(trim(text_value)) = 'code-1' as equal_to, lower(trim(text_value)) like 'code-1%' as starts_with,
               lower(trim(text_value)) like '%-2' as ends_with, lower(trim(text_value)) like '%de-3%' as contains,
               text_value is null or trim(text_value) = '' as is_empty
        from {entity_attributes}""",
    "typed_criteria": """
        select entity_attribute_id, coalesce(n = 12, false) as int_equal, coalesce(n between 5 and 50, false) as int_between, coalesce(n > 12, false) as int_above,
               coalesce(n <= 12, false) as int_up_to, coalesce(d < date '2024-01-15', false) as date_before, coalesce(d >= date '2024-01-15', false) as date_from
        from (select entity_attribute_id, case when regexp_full_match(trim(text_value), '-?[0-9]+') then cast(trim(text_value) as int) end as n,
                     case when regexp_full_match(text_value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') then cast(text_value as date) end as d from {entity_attributes}) x""",
    "search_box": """select user_id, tenant_id, full_name from {users} where lower(full_name) like '%r#00000001%' or lower(login) like '%r#00000001%'
        or lower(email) like '%r#00000001%' or cast(user_id as varchar) like '%r#00000001%'""",
    "filter_conversion": f"""
        with known(kind, original, converted) as (values {_CONVERTED}), kinds as (select distinct kind from known),
        sent as (select * from known union all select kind, 'no such code', 'Desconhecido' from kinds),
        held as (select kind, status_id as original from kinds, (select distinct status_id from {{attempts}}) s)
        select kind, original, converted, 'sent' as origin from sent
        union all select h.kind, h.original, coalesce(s.converted, 'not sent'), 'held' from held h left join sent s on s.kind = h.kind and s.original = h.original""",
    "code_translate": """select status_id, count(*) as n, 'Desconhecido' as not_a_code,
        case when status_id = 'em_andamento' then 'Em Andamento' else 'Concluído' end as label from {attempts} group by status_id""",
    "format_duration": f"select attempt_id, activity_id, {clock('seconds * 37')} as clock, {short('seconds * 37')} as short from {{activity_access}}",
    "format_percent": f"""
        select progress_id, {comma(share("finished_modules", "total_modules"))} || '%' as share, {share("exempt_modules", "finished_modules")} as of_done, {comma("score")} as comma,
               replace(replace(replace(format('{{:,.2f}}', cast(score as double)), ',', '#'), '.', ','), '#', '.') as grouped from {{track_progress}}""",
    "date_formats": f"""select user_id, strftime(updated_at, '%d/%m/%Y') as day, {minute("updated_at")} as minute, {second("updated_at")} as second,
        substring(full_name, 1, 11) as clipped from {{users}}""",
    "optional_filters": f"""
        select m.tenant_id, e.environment_id, t.track_id, r.role_id, count(*) as links
        from {{roles}} r join {{users}} u on u.user_id = r.user_id and u.tenant_id = r.tenant_id and {REAL} and u.is_active
        join {{modules}} m on m.module_id = r.entity_id and m.tenant_id = r.tenant_id and m.is_active and m.is_visible
        join {{tracks}} t on t.track_id = m.track_id and t.tenant_id = m.tenant_id
        join {{environment_tracks}} et on et.track_id = t.track_id and et.tenant_id = t.tenant_id
        join {{environments}} e on e.environment_id = et.environment_id and e.tenant_id = et.tenant_id and e.is_available and e.environment_id in (1, 2, 5)
        where r.entity_type = 'RD' and r.role_id in (1, 3) and r.created_at between timestamp '1996-03-01 00:00:00' and timestamp '1999-03-01 00:00:00'
        group by m.tenant_id, e.environment_id, t.track_id, r.role_id""",
    **{f"audience_{name}": body for name, body in AUDIENCES.items()},
}

ORACLES: dict[str, str] = {name: with_tables(body, BLOCKS, name) for name, body in _CHECKS.items()}
# The table functions give what the operators give.
_SAME_AS = {
    "sql_user_attributes": "attributes_latest", "sql_settings": "settings_overlay", "sql_environment_settings": "environment_settings_overlay",
    "sql_editable_entities": "editable_environments", "sql_label_text": "label_override", "sql_all_groups": "all_groups_filtered",
}
ORACLES.update({name: ORACLES[other] for name, other in _SAME_AS.items()})
