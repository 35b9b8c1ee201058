"""Target audiences: users who meet every included criterion and no exception."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import day_second
from lumenpath.functions.predicates import LITERAL_VALUES, all_of, any_of, is_real_user, mentions, text_matches, typed_matches, where_all
from lumenpath.operators.sizes import broadcast_if_small
from lumenpath.sources import Platform
from lumenpath.sources.staging import Stage

WHO = ["user_id", "tenant_id"]
WORD_BITS = 62  # criteria per bigint mask; longer lists use several words

# Attribute types that criteria know.
TEXT, INTEGER, DATE, MULTIPLE, SELECT = 1, 2, 4, 6, 7


@dataclass(frozen=True)
class Criterion:
    """One row of an audience definition.

    ``entity_type`` is an entity code, ``kind`` the criterion (``competition``, ``track_finished``,
    ``contains``, ...), ``entity_id`` the entity, option or flag it names, ``value``/``value_2`` operands.
    """

    tenant_id: str
    entity_type: str
    kind: str
    entity_id: int | None = None
    attribute_id: int | None = None
    value: str | None = None
    value_2: str | None = None

    @property
    def key(self) -> str:
        """What has to be met once: the kind, or the attribute (its listed values are alternatives)."""
        if self.entity_type == codes.ATTRIBUTE_VALUE:
            return f"attribute_{self.attribute_id}"
        return _KIND_OF_TYPE.get(self.entity_type, self.kind)


_KIND_OF_TYPE = {
    codes.GROUP: "group", codes.USER_PROFILE: "userProfile", codes.ADMIN_PROFILE: "adminProfile",
    codes.USER_STATUS: "userStatus", codes.USER: "user",
}


def _only(df: DataFrame, criteria: Sequence[Criterion], column: str) -> DataFrame:
    """Rows whose column holds an entity that a criterion of their tenant names.

    Criteria are as large as a request, so they become literals that reach the scan; a very long list is joined.
    """
    wanted = sorted({(c.tenant_id, c.entity_id) for c in criteria if c.entity_id is not None})
    if len(wanted) > LITERAL_VALUES:
        listed = df.sparkSession.createDataFrame(wanted, f"tenant_id string, {column} bigint")
        return df.join(F.broadcast(listed), [column, "tenant_id"], "left_semi").select(*df.columns)
    tenants = {tenant: [i for t, i in wanted if t == tenant] for tenant, _ in wanted}
    return df.where(any_of([(F.col("tenant_id") == t) & F.col(column).isin(ids) for t, ids in tenants.items()] or [F.lit(False)]))


def _of_tenants(df: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    return df.where(F.col("tenant_id").isin(sorted({c.tenant_id for c in criteria})))


def _by_groups(platform: Platform, environments: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Members of the groups attached to the environments, with ``columns`` of these; groups are folded before members meet them."""
    keys = ["group_id", "tenant_id"]
    attached = platform.environment_groups.select("environment_id", *keys).join(environments, ["environment_id", "tenant_id"])
    groups = broadcast_if_small(attached.select(*keys, *columns).distinct())
    return platform.group_members.select("user_id", *keys).join(groups, keys, "inner" if columns else "left_semi").select(*WHO, *columns)


def in_environment(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    available = platform.environments.where("is_available").select("environment_id", "tenant_id")
    return _by_groups(platform, _only(available, criteria, "environment_id"))


def _absent(key: str) -> Callable[[Platform, Sequence[Criterion]], DataFrame]:
    """No progress row for at least one of the named entities: counted per user, not crossed with users."""

    def build(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
        named = Counter(tenant for tenant, _ in {(c.tenant_id, c.entity_id) for c in criteria})
        wanted = any_of((F.col("tenant_id") == t) & (F.coalesce("_seen", F.lit(0)) < n) for t, n in named.items())
        seen = _only(platform.track_progress, criteria, key).select(*WHO, key).distinct().groupBy(*WHO).agg(F.count("*").alias("_seen"))
        return _of_tenants(platform.users.select(*WHO), criteria).join(seen, WHO, "left").where(wanted).select(*WHO)

    return build


def without_role(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    playing = platform.roles.where(F.col("role_id").isin(*codes.PLAYING_ROLES)).select(*WHO)
    return _of_tenants(platform.users.select(*WHO), criteria).join(playing, WHO, "left_anti")


def _completion(key: str, finished: bool) -> Callable[[Platform, Sequence[Criterion]], DataFrame]:
    def build(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
        sums = (
            _only(platform.track_progress, criteria, key)
            .groupBy(*WHO, key)
            .agg(F.sum("total_modules").alias("_all"), F.sum("finished_modules").alias("_done"))
        )
        done = F.coalesce((F.col("_all") == F.col("_done")) & (F.col("_all") > 0), F.lit(False))
        return sums.where(done if finished else ~done).select(*WHO)

    return build


def in_track(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    """A role on a module, on the track itself or on a module link of it, within an environment of the user's groups."""
    track = ["track_id", "tenant_id"]
    wanted = _only(platform.tracks.where("is_active").select(*track), criteria, "track_id")
    entities = (
        platform.modules.select(F.col("module_id").alias("entity_id"), *track, F.lit(codes.MODULE).alias("entity_type"))
        .unionByName(platform.module_links.select(F.col("link_id").alias("entity_id"), *track, F.lit(codes.MODULE_LINK).alias("entity_type")))
        .unionByName(wanted.select(F.col("track_id").alias("entity_id"), *track, F.lit(codes.TRACK).alias("entity_type")))
    )
    entities = broadcast_if_small(_only(entities, criteria, "track_id").join(wanted, track, "left_semi"))
    held = (
        platform.roles.where(F.col("role_id").isin(*codes.PLAYING_ROLES))
        .select(*WHO, "entity_id", F.trim("entity_type").alias("entity_type"))
        .join(entities, ["entity_id", "entity_type", "tenant_id"])
        .select(*WHO, "track_id").distinct()
    )
    offered = _only(platform.environment_tracks.select("environment_id", *track), criteria, "track_id").join(wanted, track, "left_semi")
    return held.join(_by_groups(platform, offered, ["track_id"]), [*WHO, "track_id"], "left_semi").select(*WHO)


def in_group(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    return _only(platform.group_members, criteria, "group_id").select(*WHO)


def with_role(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    return _only(platform.roles.where(F.col("role_id").isin(*codes.PLAYING_ROLES)), criteria, "role_id").select(*WHO)


def with_admin_profile(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    return _only(platform.profile_users, criteria, "profile_id").select(*WHO)


def with_status(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    wanted = sorted({(c.tenant_id, c.entity_id == 1) for c in criteria if c.entity_id is not None})
    flags = [(F.col("tenant_id") == t) & (F.col("is_active") == active) for t, active in wanted]
    return platform.users.where(any_of(flags or [F.lit(False)])).select(*WHO)


def named_users(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    return _only(platform.users, criteria, "user_id").select(*WHO)


def with_attribute(platform: Platform, criteria: Sequence[Criterion]) -> DataFrame:
    """Users for whom some criterion of one attribute holds; options by id, the rest by comparison of the text."""
    c, attribute = F.col, criteria[0].attribute_id
    kind_of = _of_tenants(platform.attributes.where(c("is_active") & (c("attribute_id") == attribute)), criteria).select("tenant_id", "type_id")
    kind_of = broadcast_if_small(kind_of)
    rows = platform.entity_attributes.where((F.trim("entity_type") == codes.USER) & (c("attribute_id") == attribute)).select(
        c("entity_id").alias("user_id"), "tenant_id", "value_id", "text_value"
    )
    rows = _of_tenants(rows, criteria).join(kind_of, "tenant_id")

    def holds(one: Criterion) -> Column:
        low, high = F.lit(one.value).cast("string"), F.lit(one.value_2).cast("string")
        operation = F.lit(one.kind)
        number = (c("type_id") == INTEGER) & typed_matches(operation, c("text_value"), low, high, "int")
        date = (c("type_id") == DATE) & typed_matches(operation, c("text_value"), low, high, "date")
        text = (c("type_id") == TEXT) & text_matches(operation, c("text_value"), low) if one.kind != "is_empty" else F.lit(False)
        return (c("tenant_id") == one.tenant_id) & F.coalesce(number | date | text, F.lit(False))

    options = _only(rows.where(c("type_id").isin(SELECT, MULTIPLE)), [x for x in criteria if (x.entity_id or 0) > 0], "value_id").select(*WHO)
    compared = [holds(x) for x in criteria if not x.entity_id]
    met = options.unionByName(rows.where(any_of(compared)).select(*WHO)) if compared else options

    blank_for = [x for x in criteria if x.kind == "is_empty" and not x.entity_id]
    if blank_for:
        # Empty means a blank value or no row at all: everybody but those whose rows all hold a value.
        blank = c("text_value").isNull() | (c("text_value") == "")
        texts = _of_tenants(rows.where(c("type_id") == TEXT), blank_for)
        filled = texts.groupBy(*WHO).agg(F.count_if(blank).alias("_blank")).where("_blank = 0").select(*WHO)
        asked = _of_tenants(platform.users.select(*WHO), blank_for).join(kind_of.where(c("type_id") == TEXT), "tenant_id", "left_semi")
        met = met.unionByName(asked.join(filled, WHO, "left_anti"))
    return met


# Criterion kind -> builder of the (user_id, tenant_id) rows that meet it.
BUILDERS: dict[str, Callable[[Platform, Sequence[Criterion]], DataFrame]] = {
    "competition": in_environment,
    "competition_not_participate": _absent("environment_id"),
    "competition_not_participate_any": without_role,
    "competition_finished": _completion("environment_id", True),
    "competition_not_finished": _completion("environment_id", False),
    "track": in_track,
    "track_not_participate": _absent("track_id"),
    "track_finished": _completion("track_id", True),
    "track_not_finished": _completion("track_id", False),
    "group": in_group,
    "userProfile": with_role,
    "adminProfile": with_admin_profile,
    "userStatus": with_status,
    "user": named_users,
}


def _grouped(criteria: Sequence[Criterion]) -> dict[str, list[Criterion]]:
    groups: dict[str, list[Criterion]] = {}
    for criterion in criteria:
        groups.setdefault(criterion.key, []).append(criterion)
    return groups


def matches(platform: Platform, criteria: Sequence[Criterion]) -> list[tuple[str, DataFrame]]:
    """Per criterion key, the users who meet it, whatever their state; a user may come more than once."""
    found = []
    for key, rows in _grouped(criteria).items():
        build = with_attribute if rows[0].entity_type == codes.ATTRIBUTE_VALUE else BUILDERS[key]
        found.append((key, build(platform, rows)))
    return found


def required_criteria(criteria: Sequence[Criterion]) -> dict[str, int]:
    """Number of criteria to meet per tenant: the kinds present plus the distinct attributes."""
    return {t: len({c.key for c in criteria if c.tenant_id == t}) for t in {c.tenant_id for c in criteria}}


STATUS = "userStatus"


def audience(platform: Platform, include: Sequence[Criterion], exclude: Sequence[Criterion] = ()) -> DataFrame:
    """``(user_id, tenant_id)`` of the audience.  No criteria, no audience.

    Every criterion, included or excluded, has a bit, and one aggregation gives each user the bits of those met.  A user belongs to the
    audience when they cover the tenant's mask and hold no excluded bit.  ``bit_or`` is combined on the map side, so one narrow shuffle
    replaces a distinct count and an anti-join for each exception.  Inactive users can meet the status criterion only, and be
    excepted by it only.
    """
    included, excluded = matches(platform, [c for c in include if c.kind != "user"]), matches(platform, exclude)
    if not included:
        return platform.users.select(*WHO).where(F.lit(False))
    slots = {(side, key): divmod(place, WORD_BITS) for place, (side, key) in enumerate([(True, k) for k, _ in included] + [(False, k) for k, _ in excluded])}
    union = None
    for side, found in ((True, included), (False, excluded)):
        for key, users in found:
            word, bit = slots[side, key]
            marked = users.select(*WHO, F.lit(word).alias("word"), F.lit(1 << bit).cast("bigint").alias("bits"))
            union = marked if union is None else union.unionByName(marked)
    words = range(1 + max(word for word, _ in slots.values()))
    met = _of_tenants(union, include).groupBy(*WHO).agg(
        *[F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("bits"))), F.lit(0).cast("bigint")).alias(f"bits{w}") for w in words]
    )

    def masks(wanted: list[tuple[bool, str]]) -> dict[int, int]:
        found: dict[int, int] = {}
        for word, bit in (slots[slot] for slot in wanted):
            found[word] = found.get(word, 0) | 1 << bit
        return found

    def bits(word: int, mask: int) -> Column:
        return F.col(f"bits{word}").bitwiseAND(F.lit(mask).cast("bigint"))

    def covers(tenant: str) -> Column:
        keys = {c.key for c in include if c.tenant_id == tenant and c.kind != "user"}
        whole = [bits(w, mask) == mask for w, mask in masks([(True, key) for key in keys]).items()]
        return all_of([F.col("tenant_id") == tenant, *whole] + ([] if keys <= {STATUS} else [F.col("is_active")]))

    def excepted(keys: list[str]) -> Column:
        return any_of([bits(w, mask) != 0 for w, mask in masks([(False, key) for key in keys]).items()] or [F.lit(False)])

    people = platform.users.where(is_real_user()).select(*WHO, "is_active")
    tenants = sorted({c.tenant_id for c in include if c.kind != "user"})
    status, others = ([key for key, _ in excluded if (key == STATUS) is same] for same in (True, False))
    out = excepted(status) | (F.col("is_active") & excepted(others))
    return met.join(people, WHO).where(any_of(covers(t) for t in tenants) & ~out).select(*WHO)


def audience_users(
    platform: Platform,
    include: Sequence[Criterion],
    exclude: Sequence[Criterion] = (),
    search: str | None = None,
    skip: int = 0,
    take: int | None = None,
) -> DataFrame:
    """The audience with user details, the size of the whole audience on every row, ordered by name.

    ``skip``/``take`` page the list; without ``take`` the list is whole.
    """
    users = platform.users.select(
        *WHO, F.col("full_name").alias("name"), F.coalesce("email", F.lit("")).alias("email"), "login", "created_by", "updated_by",
        day_second(F.col("updated_at")).alias("updated_at"), day_second(F.col("created_at")).alias("created_at"), "is_active",
    )
    members = users.join(audience(platform, include, exclude), WHO, "left_semi")
    members = where_all(members, mentions([F.col(c) for c in ("name", "login", "email", "user_id")], search))
    if skip and take is None:
        raise ValueError("skip needs take: an open-ended page would pass through one task")
    return page_of(members, ["name", "tenant_id", "user_id"], skip, take, "total_users")


def page_of(rows: DataFrame, order: Sequence[str], skip: int, take: int | None, total: str) -> DataFrame:
    """Rows ``skip`` to ``skip + take`` in an order that tells all rows apart, with the number of all rows beside each.

    The rows are written once in ranges of the order, and counted by range: one number for each comes to the driver.  A page,
    however deep, then reads the ranges it lies in and nothing else; without ``take`` all of them.
    """
    stage = Stage(rows.sparkSession, "page")
    ranges = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    written = stage.keep("rows", lambda: ranges, partition_by=("_range",))
    counts = sorted(tuple(row) for row in written.groupBy("_range").count().collect())
    size = sum(n for _, n in counts)
    before, first = 0, {}
    for number, n in counts:
        if before + n > skip and (take is None or before < skip + take):
            first[number] = before
        before += n
    page = written.where(F.col("_range").isin(list(first)) if first else F.lit(False))
    if take is not None and first:
        starts = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
        place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.element_at(starts, F.col("_range"))
        page = page.withColumn("_place", place).where((F.col("_place") > skip) & (F.col("_place") <= skip + take)).drop("_place")
    return page.orderBy(*order).drop("_range").withColumn(total, F.lit(size).cast("bigint"))
