"""The platform tables as the lake stores them, under the names the library uses.

Lake columns follow a naming scheme (``id_``, ``texto_``, ``numero_``, ``flag_``, ``data_``); each
table's columns are listed with the names they get here.
Types are settled here once: codes are trimmed, flags become booleans, times lose their zone in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.sources.platform import Platform

# Table -> (lake table, name of the key held in ``id``).
LAKE_TABLES: dict[str, tuple[str, str | None]] = {
    "users": ("usuario", "user_id"), "groups": ("grupo", "group_id"), "group_members": ("usuario_grupo", None),
    "group_tree": ("cache_arvore_grupo", None), "environments": ("competicao", "environment_id"),
    "environment_groups": ("competicao_grupo", None), "environment_tracks": ("competicao_trilha", None),
    "tracks": ("trilha", "track_id"), "modules": ("rodada", "module_id"), "module_links": ("rodada_link", "link_id"),
    "activities": ("atividade", "activity_id"), "module_activities": ("rodada_atividade", None),
    "activity_types": ("atividade_tipo", "type_id"), "user_weights": ("rodada_atividade_usuario", None),
    "roles": ("usuario_perfil_entidade", None), "attempts": ("tentativa", "attempt_id"),
    "activity_access": ("acesso_atividade", None), "answers": ("resposta", None), "exemptions": ("dispensa_rodada", None),
    "choices": ("atividade_alternativa", "choice_id"), "choice_answers": ("resposta_alternativa", None),
    "form_questions": ("pergunta_formulario", "question_id"), "form_answers": ("resposta_atividade_formulario", None),
    "form_choices": ("alternativa_formulario", "choice_id"), "form_choice_answers": ("resposta_alternativa_formulario", None),
    "minigame_answers": ("resposta_minigame", None), "minigame_choices": ("alternativa_minigame", "choice_id"),
    "minigame_choice_answers": ("resposta_alternativa_minigame", None),
    "track_progress": ("usuario_progresso_trilha", "progress_id"), "recertifications": ("recertificacao", "recertification_id"),
    "environment_scores": ("pontuacao_usuario_por_competicao", None), "entity_access": ("acesso_entidade", None),
    "attributes": ("atributo", "attribute_id"), "attribute_types": ("atributo_tipo", "type_id"),
    "attribute_items": ("atributo_grupo_item", None), "entity_attributes": ("entidade_atributo", "entity_attribute_id"),
    "attribute_values": ("atributo_valor", "value_id"), "labels": ("rotulo", "label_id"), "label_texts": ("rotulo_idioma", None),
    "label_overrides": ("rotulo_idioma_cliente", None), "settings": ("configuracao", "setting_id"),
    "tenant_settings": ("configuracao_cliente", None), "environment_settings": ("configuracao_competicao", "setting_id"),
    "tenant_environment_settings": ("configuracao_competicao_cliente", None), "audiences": ("publico_alvo", "audience_id"),
    "imports": ("importacao", "import_id"), "achievements": ("conquista", "achievement_id"),
    "entity_groups": ("entidade_grupo", None), "admin_profiles": ("perfil_admin", "profile_id"),
    "profile_users": ("perfil_usuario", None), "profile_groups": ("perfil_grupo_acesso", None),
}

# Lake columns that read the same in every table.
COMMON = {
    "id_cliente": "tenant_id", "id_usuario": "user_id", "id_grupo": "group_id", "id_competicao": "environment_id",
    "id_trilha": "track_id", "id_rodada": "module_id", "id_atividade": "activity_id", "id_tentativa": "attempt_id",
    "id_alternativa": "choice_id", "id_pergunta": "question_id", "id_pergunta_formulario": "question_id",
    "id_pergunta_minigame": "question_id", "id_entidade": "entity_id", "id_entidade_tipo": "entity_type",
    "id_atributo": "attribute_id", "id_atributo_valor": "value_id", "id_rotulo": "label_id", "id_idioma": "language_id",
    "id_configuracao": "setting_id", "id_configuracao_competicao": "setting_id", "id_perfil": "profile_id", "id_admin": "admin_id",
    "id_tipo": "type_id", "id_status": "status_id", "id_perfil_jogo": "role_id", "id_origem_cadastro": "origin_created",
    "id_origem_ultima_atualizacao": "origin_updated", "id_grupo_pai": "parent_group_id", "id_atributo_tipo": "type_id",
    "id_rotulo_nome": "label_id", "id_rotulo_valor": "label_id", "id_ranking_personalizado": "ranking_id",
    "id_tentativa_recertificacao": "recertification_attempt_id", "id_rodada_url": "target_module_id",
    "id_perfil_grupo_acesso_tipo": "access_kind", "flag_permitir_visualizar_entidades_sem_grupo": "sees_ungrouped",
    "id_root": "root_id", "id_pai": "parent_id", "numero_saltos": "hops",
    "texto_nome": "name", "texto_nome_completo": "full_name", "texto_email": "email", "texto_login": "login",
    "texto_texto": "text", "texto_chave": "key", "texto_valor": "text_value", "texto_alternativa": "text", "texto_tipo": "kind",
    "texto_titulo": "title", "texto_enunciado": "statement", "texto_resposta_dissertativa": "essay_text",
    "texto_feedback": "feedback", "texto_arquivo": "file", "texto_grupo": "group_label", "texto_ajuda": "help_label",
    "texto_grupo_configuracao": "config_group", "flag_status": "is_active", "flag_disponivel": "is_available",
    "flag_visivel": "is_visible", "flag_padrao": "is_default", "flag_correta": "is_correct", "flag_corrigida": "is_reviewed",
    "flag_selecionada": "is_selected", "flag_requer_correcao": "requires_review", "flag_pontuacao_tempo_restante": "allows_time_bonus",
    "flag_usuarios_vinculo_obrigatorio": "for_mandatory", "flag_usuarios_vinculo_participa": "for_participant",
    "data_cadastro": "created_at", "data_ultima_atualizacao": "updated_at", "data_exclusao": "deleted_at", "data_inicio": "starts_at",
    "data_termino": "ends_at", "data_dispensa": "exempted_at", "data_inicio_para_realizacao": "starts_at",
    "data_termino_para_realizacao": "ends_at", "data_resposta": "answered_at", "data_ultimo_acesso": "last_access_at",
    "data_primeiro_acesso": "first_access_at", "data_conclusao": "finished_at", "data_valor": "date_value", "hora_valor": "time_value",
    "numero_ordem": "order_number", "numero_peso": "weight", "numero_nota": "grade", "numero_bonus_desafio": "challenge_bonus",
    "numero_pontuacao_tempo_restante": "time_bonus", "numero_tempo_em_segundos": "seconds",
    "numero_tempo_acesso_em_segundos": "access_seconds", "numero_porcentagem_acertos": "hit_ratio", "numero_resposta_escala": "scale",
    "numero_ordem_grupo": "group_order", "numero_ordem_configuracao": "config_order",
    "numero_ordem_grupo_configuracao": "config_group_order", "numero_tab_configuracao": "config_tab",
    "numero_periodo_expiracao_recertificacao_em_dias": "expiry_days",
    "numero_periodo_recertificacao_disponivel_em_dias": "available_days",
    "criado_por": "created_by", "atualizado_por": "updated_by",
}
# The counters of a progress row, ``numero_total_rodadas_<word>``.
PROGRESS_WORDS = {
    "aguardando_correcao": "awaiting", "aprovadas": "approved", "concluidas": "finished", "dispensadas": "exempt",
    "em_andamento": "in_progress", "expiradas": "expired", "nao_iniciadas": "not_started", "nao_liberadas": "not_released",
    "realizadas_fora_do_prazo": "late", "reprovadas": "failed",
}
# Columns that read differently in one table.
SPECIAL = {
    "tracks": {"texto_descricao": "name"},
    "modules": {"numero_carga_horaria": "workload_minutes"},
    "activities": {"numero_carga_horaria": "workload_minutes"},
    "settings": {"texto_descricao": "description"},
    "environment_settings": {"texto_descricao": "description"},
    "attempts": {"numero_pontuacao": "points"},
    "environment_scores": {"numero_pontuacao": "score"},
    "track_progress": {
        "numero_pontuacao": "score", "numero_carga_horaria": "workload_seconds", "numero_total_rodadas": "total_modules",
        **{f"numero_total_rodadas_{lake}": f"{name}_modules" for lake, name in PROGRESS_WORDS.items()},
    },
}

FLAGS = {"sees_ungrouped", "requires_review", "allows_time_bonus", "for_mandatory", "for_participant"}
PADDED_CODES = {"entity_type", "status_id", "kind", "access_kind"}


def _settled(column: Column, name: str, kind: str) -> Column:
    if name.startswith("is_") or name in FLAGS:
        return column.cast("boolean")
    if name in PADDED_CODES:
        return F.trim(column)
    if name.endswith("_at") and kind == "timestamp":
        return F.to_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz")
    if name.endswith("_id") and kind in ("int", "smallint", "tinyint"):
        return column.cast("bigint")
    return column


def from_lake(table: str, df: DataFrame) -> DataFrame:
    """One lake table under the library's names; columns the library has no use for are left out."""
    _, key = LAKE_TABLES[table]
    names = {**COMMON, **SPECIAL.get(table, {})}
    if key:
        names["id"] = key
    kinds = dict(df.dtypes)
    columns = []
    for lake_name in df.columns:
        name = names.get(lake_name)
        if name:
            columns.append(_settled(F.col(f"`{lake_name}`"), name, kinds[lake_name]).alias(name))
    return df.select(*columns)


def lake_platform(spark: SparkSession, namespace: str, tenant_id: str | None = None) -> Platform:
    """The platform of a catalog namespace, such as ``lake.silver``."""
    return Platform(lambda table: from_lake(table, spark.table(f"{namespace}.{LAKE_TABLES[table][0]}")), tenant_id)


def lake_folder(spark: SparkSession, root: str, tenant_id: str | None = None) -> Platform:
    """The platform of a folder with one parquet directory per lake table."""
    return Platform(lambda table: from_lake(table, spark.read.parquet(f"{root}/{LAKE_TABLES[table][0]}")), tenant_id)
