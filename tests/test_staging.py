"""How staged tables are written."""

import os

from lumenpath.sources.staging import Stage


def test_partitions_are_written_without_a_sort(spark, rows, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr("lumenpath.sources.staging.PARTITION_FILES", 7)
    frame = rows([(1, "a"), (2, "b"), (3, "a"), (4, None)], "n bigint, tenant_id string")

    def build_frame():
        return frame.coalesce(1)

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, put = spark.conf.get(key), type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: (seen.setdefault(k, v), put(self, k, v))[1])
    kept = Stage(spark, "partitioned").keep("rows", build_frame, ("tenant_id",))
    assert seen[key] == 7 and spark.conf.get(key) == before
    assert sorted(map(tuple, kept.select("n", "tenant_id").collect())) == [(1, "a"), (2, "b"), (3, "a"), (4, None)]


def test_staged_files_are_packed_closely(spark, rows):
    frame = rows([(n, "a") for n in range(9)], "n bigint, tenant_id string")
    stage = Stage(spark, "packed")
    for kept in (stage.keep("plain", lambda: frame), stage.keep("parted", lambda: frame, ("tenant_id",)), stage.keep("dealt", lambda: frame, (), ("n",))):
        assert kept.count() == 9 and all(file.endswith(".zstd.parquet") for file in kept.inputFiles())


def test_packed_files_are_no_measure_of_a_broadcast(spark):
    by_files, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {key: spark.conf.get(key, None) for key in (by_files, measured)}
    try:
        spark.conf.set(by_files, "10m")
        spark.conf.unset(measured)
        stage = Stage(spark, "broadcast")
        many = stage.keep("many", lambda: spark.range(400_000).selectExpr("id * 7 as id"))
        few = stage.keep("few", lambda: spark.range(400).selectExpr("id * 7 as id"))
        plans = [spark.range(1 << 40).join(x, "id", "left_semi")._jdf.queryExecution().executedPlan().toString() for x in (many, few)]
        assert ["BroadcastHashJoin" in plan for plan in plans] == [False, True]
        assert spark.conf.get(measured) == str(10 << 20)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_dropped_frame_takes_no_room(spark, rows):
    stage = Stage(spark, "dropped")
    frame = rows([(1,)], "n bigint")
    folder = stage.keep("first", lambda: frame).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    stage.drop("first")
    assert not os.path.exists(folder)
    assert stage.keep("first", lambda: frame).count() == 1
