"""A learning platform as a set of lazily opened tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables without a tenant column: they are shared by all tenants.
SHARED_TABLES = frozenset(
    {"activity_types", "attribute_types", "labels", "label_texts", "settings", "environment_settings"}
)


class Platform:
    """Opens a table on first use: ``platform.users`` or ``platform["users"]``.

    ``for_tenant`` narrows every tenant table with a plain equality filter, so the scan prunes
    partitions when the table is partitioned by tenant.
    """

    def __init__(self, load: Callable[[str], DataFrame], tenant_id: str | None = None):
        self._load = load
        self._open: dict[str, DataFrame] = {}
        self.tenant_id = tenant_id

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Platform:
        return cls(frames.__getitem__)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Platform:
        return cls(lambda name: spark.read.parquet(f"{root}/{name}"))

    def for_tenant(self, tenant_id: str | None) -> Platform:
        return self if tenant_id is None else Platform(self._load, tenant_id)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            table = self._load(name)
            if self.tenant_id is not None and name not in SHARED_TABLES:
                table = table.where(F.col("tenant_id") == self.tenant_id)
            self._open[name] = table
        return self._open[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]
