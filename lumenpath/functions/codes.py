"""Codes stored by the platform and the labels shown for them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: attempt states as stored --------------------------------------------------
CANCELLED = "cancelado"
NOT_STARTED = "nao_iniciado"
IN_PROGRESS = "em_andamento"
AWAITING_REVIEW = "aguardando_correcao"
DONE = "concluido"
APPROVED = "aprovado"
FAILED = "reprovado"
LATE = "realizado_fora_prazo"

CLOSED_STATES = (DONE, APPROVED, FAILED, LATE)
PASSED_STATES = (DONE, APPROVED)
RECURRING_MODULE = "recorrente"

# ---- fixed values: entity types and roles ------------------------------------------------------
USER, ENVIRONMENT, TRACK, MODULE, MODULE_LINK, ACTIVITY, ACHIEVEMENT = "US", "CP", "TR", "RD", "RL", "AT", "CQ"
GROUP, USER_PROFILE, ADMIN_PROFILE, USER_STATUS, ATTRIBUTE_VALUE = "GR", "UP", "AP", "SU", "AV"
MANDATORY, PARTICIPANT, MANAGER = 1, 2, 3
PLAYING_ROLES = (MANDATORY, PARTICIPANT, MANAGER)

# ---- fixed values: activity types grouped by how they are answered -----------------------------
CHOICE_TYPES = (
    "multipla_escolha", "verdadeiro_falso", "multiplas_respostas", "pesquisaMultiplaEscolha", "pesquisaMultiplasRespostas",
)
ESSAY_TYPES = ("dissertativaPontuacao", "dissertativa")
FORM_TYPE = "formulario"
MINIGAME_TYPE = "minigame"

# ---- fixed values: settings that change a report -------------------------------------------------
PARTIAL_SCORE_SETTING = "count_partial_score_in_rankings"

# ---- fixed values: filter kind -> code -> label ---------------------------------------------------
UNKNOWN = "Desconhecido"
DICTIONARIES: dict[str, dict[str, str]] = {
    "role": {"1": "Obrigatório", "2": "Participa", "3": "Gestor"},
    "environment_status": {
        "finished": "Concluído", "expired": "Expirado (Não concluído)", "in_progress": "Em andamento",
        "not_started": "Não iniciado", "not_released": "Não liberado", "exempted": "Dispensado",
    },
    "module_status": {
        "approved": "Aprovado", "reproved": "Reprovado", "out_of_date": "Fora do Prazo",
        "expired": "Expirado (Não Realizado)", "awaiting_approval": "Aguardando Correção",
        "in_progress": "Em Andamento", "not_started": "Não Iniciado", "not_released": "Não Liberado",
        "exempted": "Dispensado", "invalid_certification": "Certificação Inválida",
        "valid_certification": "Certificação Válida",
    },
    "activity_status": {
        "finished": "Concluído", "expired": "Expirado", "awaiting_approval": "Aguardando Correção",
        "in_progress": "Em Andamento", "not_started": "Não Iniciado", "not_released": "Não Liberado",
        "exempted": "Dispensado",
    },
    "track_status": {
        "finished": "Concluído", "expired": "Expirado (Não Concluído)", "in_progress": "Em Andamento",
        "not_started": "Não Iniciado", "not_released": "Não Liberado", "exempted": "Dispensado",
        "invalid_certification": "Certificação Inválida", "valid_certification": "Certificação Válida",
    },
    "question_status": {"pending": "Pendente", "answered": "Respondida"},
    "notification_status": {
        "summary": "Rascunho", "wating_for_sending": "Aguardando envio", "failed": "Falha", "sent": "Enviado",
    },
    "attempt_type": {"recertification": "Recertificação", "default": "Padrão"},
    "user_status": {"1": "Ativo", "2": "Inativo"},
}
# A module that is finished without a grade has a label but no filter code.
MODULE_STATUS_LABELS = {**DICTIONARIES["module_status"], "finished": "Concluido"}
# Labels of the wide report, of users, of answers to yes or no, of a link's origin, and of the time of completion.
COLUMN_STATUS_LABELS = {
    "exempted": "Disp/Inat", "awaiting_approval": "Aguardando Correção", "approved": "Aprovado",
    "reproved": "Reprovado", "finished": "Concluido", "not_started": "Não Iniciado",
    "in_progress": "Em Andamento", "not_done": "Não Realizado",
}
ACTIVE_LABEL, INACTIVE_LABEL = "Ativo", "Inativo"
YES, NO = "Sim", "Não"
NOT_TAKING_PART = "Não Participa"
LATE_LABEL, IN_TIME_LABEL = "Fora do Prazo", "Dentro do Prazo"
ORIGIN_LABELS = {"1": "Manual", "2": "Público Alvo", "3": "API", "4": "Importação de Dados"}


def label_of(code: Column, labels: dict[str, str], other: str | None = None) -> Column:
    """Label of a code held in a column; ``other`` (or NULL) for codes the dictionary lacks."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(lookup, F.trim(code.cast("string"))), F.lit(other))


def user_status_label(is_active: Column) -> Column:
    return F.when(is_active, ACTIVE_LABEL).otherwise(INACTIVE_LABEL)


def role_label(role_id: Column, other: str | None = NOT_TAKING_PART) -> Column:
    return label_of(role_id, DICTIONARIES["role"], other)


def origin_label(origin_id: Column) -> Column:
    return label_of(origin_id, ORIGIN_LABELS)
