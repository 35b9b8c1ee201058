"""Report parameters, and parsing of the strings that callers send."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone


def parse_ids(text) -> tuple[int, ...]:
    """Comma-separated whole numbers; blanks between commas are skipped.

    Anything else raises, so that a filter is never dropped without notice.
    """
    if text is None:
        return ()
    if isinstance(text, (list, tuple, set, frozenset)):
        return tuple(int(v) for v in text)
    parts = [part.strip() for part in str(text).split(",") if part.strip()]
    for part in parts:
        if not re.fullmatch(r"[+-]?[0-9]+", part):
            raise ValueError(f"not a whole number: {part!r}")
    return tuple(map(int, parts))


def parse_codes(text) -> tuple[str, ...]:
    if text is None:
        return ()
    if isinstance(text, (list, tuple, set, frozenset)):
        return tuple(str(v).strip() for v in text)
    return tuple(part.strip() for part in str(text).split(",") if part.strip())


def parse_instant(text) -> datetime | None:
    """ISO date or date-time.  A zone or offset is honoured by moving to UTC; empty text is None.

    Text that is not a date raises, so that a filter is never dropped without notice.
    """
    if text is None or isinstance(text, str) and not text.strip():
        return None
    moment = text if isinstance(text, datetime) else datetime.fromisoformat(text.strip())
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def parse_flag(text) -> bool:
    return text if isinstance(text, bool) else str(text).strip().lower() in ("true", "1")


Window = tuple[datetime | None, datetime | None]


@dataclass(frozen=True)
class ReportParams:
    """Filters shared by the reports; every empty value means "no such filter"."""

    as_of: datetime
    tenant_id: str | None = None
    admin_id: int | None = None
    user_ids: tuple[int, ...] = ()
    group_ids: tuple[int, ...] = ()
    environment_ids: tuple[int, ...] = ()
    track_ids: tuple[int, ...] = ()
    module_ids: tuple[int, ...] = ()
    activity_ids: tuple[int, ...] = ()
    activity_types: tuple[str, ...] = ()
    role_ids: tuple[int, ...] = ()
    user_flags: tuple[int, ...] = ()  # 1 active, 0 inactive
    statuses: tuple[str, ...] = ()  # canonical status codes
    attempt_types: tuple[str, ...] = ()
    windows: Mapping[str, Window] = field(default_factory=dict)
    show_inactive_environments: bool = False
    show_inactive_tracks: bool = False
    show_inactive_modules: bool = False
    show_inactive_activities: bool = False
    show_empty_dates: bool = False
    all_attempts: bool = False
    attempts_per_module: int | None = None  # with all_attempts: only so many of the newest; None keeps every one

    def window(self, name: str) -> Window | None:
        return self.windows.get(name)


# The keys callers send.  Those of the activity report, and the parameter each one fills.
_ACTIVITY_FIELDS = {
    "adminId": ("admin_id", lambda v: (parse_ids(v) or (None,))[0]),
    "customerId": ("tenant_id", lambda v: v or None),
    "userStatus": ("user_flags", parse_ids),
    "profileTrackIds": ("role_ids", parse_ids),
    "competitionId": ("environment_ids", parse_ids),
    "trackId": ("track_ids", parse_ids),
    "roundId": ("module_ids", parse_ids),
    "activityId": ("activity_ids", parse_ids),
    "activityType": ("activity_types", parse_codes),
    "userId": ("user_ids", parse_ids),
    "groupId": ("group_ids", parse_ids),
    "activityCompletionStatus": ("statuses", parse_codes),
    "showInactiveCompetition": ("show_inactive_environments", parse_flag),
    "showInactiveTrack": ("show_inactive_tracks", parse_flag),
    "showInactiveRound": ("show_inactive_modules", parse_flag),
    "showInactiveActivity": ("show_inactive_activities", parse_flag),
    "showEmptyDates": ("show_empty_dates", parse_flag),
}
_ACTIVITY_WINDOWS = {
    "firstAccessToActivityDate": "first_access",
    "lastActivityAccessDate": "last_access",
    "activityCompletionDate": "completion",
}
# Those of the other reports.
_COMMON_FIELDS = {
    "adminId": _ACTIVITY_FIELDS["adminId"],
    "clienteID": _ACTIVITY_FIELDS["customerId"],
    "usuario": ("user_ids", parse_ids),
    "userStatus": ("user_flags", parse_ids),
    "grupo": ("group_ids", parse_ids),
    "perfilUsuarioTrilhaIds": ("role_ids", parse_ids),
    "showInactiveCompetition": ("show_inactive_environments", parse_flag),
}
_ENVIRONMENTS = {"competicaoId": ("environment_ids", parse_ids)}
_TRACKS = {"trilhaId": ("track_ids", parse_ids), "showInactiveTrack": ("show_inactive_tracks", parse_flag)}
_EMPTY_DATES = {"showEmptyDates": ("show_empty_dates", parse_flag)}
_FIELDS = {
    "activity": _ACTIVITY_FIELDS,
    "module_rows": {
        **_COMMON_FIELDS, **_ENVIRONMENTS, **_TRACKS, **_EMPTY_DATES,
        "rodadaId": ("module_ids", parse_ids),
        "showInactiveRound": ("show_inactive_modules", parse_flag),
        "statusConclusaoRodada": ("statuses", parse_codes),
        "exibirTodasTentativas": ("all_attempts", parse_flag),
    },
    "module_columns": {**_COMMON_FIELDS, "competicaoID": _ENVIRONMENTS["competicaoId"], "statusConclusaoCompeticao": ("statuses", parse_codes)},
    "track": {
        **_COMMON_FIELDS, **_ENVIRONMENTS, **_TRACKS, **_EMPTY_DATES,
        "tipoDeTentativa": ("attempt_types", parse_codes),
        "statusConclusaoTrilha": ("statuses", parse_codes),
    },
    "environment": {**_COMMON_FIELDS, **_ENVIRONMENTS, **_EMPTY_DATES, "statusConclusaoCompeticao": ("statuses", parse_codes)},
}
_WINDOWS = {
    "activity": _ACTIVITY_WINDOWS,
    "module_rows": {"": "any", "roundStartDate": "start", "roundCompletionDate": "completion", "roundLinkDate": "link"},
    "module_columns": {},
    "track": {"trackStartDate": "start", "trackCompletionDate": "completion", "trackLinkDate": "link", "trackExpirationDate": "expiration"},
    "environment": {
        "competitionStartDate": "start", "competitionCompletionDate": "completion", "competitionLinkDate": "link",
        "lastCompetitionAccessDate": "last_access",
    },
}
# What holds where a key is not sent.
_DEFAULTS = {
    "activity": {},
    "module_rows": {"role_ids": (1, 2, 3)},
    "module_columns": {"role_ids": (1, 2), "user_flags": (1,)},
    "track": {"role_ids": (1, 2), "user_flags": (1,)},
    "environment": {},
}


def from_request(request: Mapping[str, object], as_of: datetime, report: str = "activity") -> ReportParams:
    """Parameters of a report from a request of strings.  Keys may be padded with blanks; unknown keys raise."""
    fields, spans = _FIELDS[report], _WINDOWS[report]
    values: dict[str, object] = dict(_DEFAULTS[report])
    ends: dict[str, dict[str, datetime | None]] = {}
    for raw_key, raw in request.items():
        key = raw_key.strip()
        if key in fields:
            name, parse = fields[key]
            values[name] = parse(raw)
            continue
        for end in ("StartDate", "EndDate"):
            whole = key if len(key) > len(end) else key[:1].upper() + key[1:]
            if whole.endswith(end) and whole[: -len(end)] in spans:
                ends.setdefault(spans[whole[: -len(end)]], {})[end] = parse_instant(raw)
                break
        else:
            raise KeyError(f"unknown report parameter {raw_key!r}")
    windows = {name: (pair.get("StartDate"), pair.get("EndDate")) for name, pair in ends.items()}
    return ReportParams(as_of=as_of, windows=windows, **values)
