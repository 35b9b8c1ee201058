import json
from datetime import datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import platform_fixture
from lumenpath.sources import lake, sinks
from lumenpath.sources.staging import Stage, shared_folder


def bag(frame, columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_gold_replaces_the_tenants_at_hand(spark, rows, tmp_path):
    ddl = "user_id bigint, tenant_id string, note string"
    gold = rows([(1, "10", "a"), (2, "20", None), (1, "20", "c")], ddl)
    path = str(tmp_path / "gold")
    with pytest.raises(sinks.MissingTable):
        sinks.read_gold(spark, path)
    sinks.write_gold(gold, path)
    assert bag(sinks.read_gold(spark, path), gold.columns) == bag(gold, gold.columns)
    sinks.write_gold(rows([(7, "20", "new")], ddl), path)
    assert bag(sinks.read_gold(spark, path), gold.columns) == [(1, "10", "a"), (7, "20", "new")]
    one = sinks.read_gold(spark, path).where("tenant_id = '10'")
    assert len(one.inputFiles()) >= 1 and "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    sinks.write_gold(rows([], ddl), path)  # no tenants: nothing is replaced
    assert sinks.read_gold(spark, path).count() == 2
    sinks.write_gold(rows([(8, "30", "x", 1.5)], ddl + ", more double"), path)  # a wider schema; older tenants lack the column
    assert bag(sinks.read_gold(spark, path), ["user_id", "more"]) == [(1, None), (7, None), (8, 1.5)]
    assert sinks.forget_gold(spark, path) == 1  # the empty write
    assert bag(sinks.read_gold(spark, path), ["user_id"]) == [(1,), (7,), (8,)]
    sinks.write_gold(gold, path, whole=True)
    assert bag(sinks.read_gold(spark, path), gold.columns) == bag(gold, gold.columns) and sinks.forget_gold(spark, path) == 3


def test_tenants_stay_text(spark, rows, tmp_path):
    gold = rows([(1, "007", "a"), (2, "1e3", "b"), (3, "2020-01-01", None), (4, "a/b=c", ""), (5, None, "none")], "user_id bigint, tenant_id string, note string")
    path = str(tmp_path / "gold")
    sinks.write_gold(gold, path)
    back = sinks.read_gold(spark, path)
    assert dict(back.dtypes)["tenant_id"] == "string"
    assert bag(back, gold.columns) == bag(gold, gold.columns)


def test_readers_never_meet_a_half_written_table(spark, rows, tmp_path):
    import threading

    path = str(tmp_path / "gold")
    version = lambda n: spark.range(4000).selectExpr("id as user_id", "concat('t', id % 5) as tenant_id", f"{n} as version")
    sinks.write_gold(version(0), path)
    opened = sinks.read_gold(spark, path)
    seen, failed, done = [], [], threading.Event()

    def read():
        try:
            while not done.is_set():
                seen.append(tuple(sinks.read_gold(spark, path).agg(F.count("*"), F.min("version"), F.max("version")).first()))
        except Exception as error:
            failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (1, 2, 3):
            sinks.write_gold(version(n), path)
        broken = version(9).withColumn("version", F.when(F.col("user_id") == 3999, F.raise_error(F.lit("lost"))).otherwise(F.col("version")).cast("int"))
        with pytest.raises(Exception, match="lost"):
            sinks.write_gold(broken, path)
    finally:
        done.set()
        reader.join()
    assert not failed and seen and all(count == 4000 and first == last for count, first, last in seen)
    assert tuple(sinks.read_gold(spark, path).agg(F.count("*"), F.max("version")).first()) == (4000, 3)
    assert tuple(opened.agg(F.count("*"), F.max("version")).first()) == (4000, 0)


def test_one_user_reads_few_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    gold = spark.range(0, 60_000, 1, 6).selectExpr(
        "(id * 7919) % 3000 as user_id", "concat('t', id % 2) as tenant_id", "id % 40 as environment_id", "id % 900 as module_id", "uuid() as note",
    )
    path = str(tmp_path / "gold")
    sinks.write_gold(gold, path, row_group_bytes=64 << 10)
    wanted = sinks.read_gold(spark, path).where("user_id = 1234 and tenant_id = 't0'")
    groups = hit = 0
    for file in wanted.inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        place = meta.schema.to_arrow_schema().names.index("user_id")
        spans = [meta.row_group(k).column(place).statistics for k in range(meta.num_row_groups)]
        groups, hit = groups + len(spans), hit + sum(s.min <= 1234 <= s.max for s in spans)
    assert groups >= 20 and hit <= 2
    assert wanted.count() == gold.where("user_id = 1234 and tenant_id = 't0'").count() > 0
    assert "EqualTo(user_id,1234)" in wanted._jdf.queryExecution().executedPlan().toString()


def test_catalog_gold_replaces_partitions(spark, rows):
    ddl = "user_id bigint, tenant_id string, note string"
    spark.sql("drop table if exists gold_of_test")
    try:
        sinks.save_gold(rows([(1, "10", "a"), (2, "020", "b")], ddl), "gold_of_test")
        sinks.save_gold(rows([(3, "020", "c")], ddl), "gold_of_test")
        assert bag(sinks.open_gold(spark, "gold_of_test"), ["user_id", "tenant_id", "note"]) == [(1, "10", "a"), (3, "020", "c")]
        sinks.save_gold(rows([(4, "30", 1.0)], "user_id bigint, tenant_id string, more double"), "gold_of_test")
        assert bag(sinks.open_gold(spark, "gold_of_test"), ["user_id", "tenant_id", "more"]) == [(4, "30", 1.0)]
    finally:
        spark.sql("drop table if exists gold_of_test")


def test_staged_tables_go_when_the_application_closes_them(spark, rows):
    import os

    held = Stage(spark, "test_close").keep("one", lambda: rows([(1,)], "i int"))
    folder = held.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(folder)
    application = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    assert folder.startswith(application.removeprefix("file:"))


def test_missing_gold_is_a_typed_error(spark):
    with pytest.raises(sinks.MissingTable):
        sinks.open_gold(spark, "no_such_gold")


def test_report_file(spark, rows, tmp_path):
    report = rows([(1, "á", None)], "user_id bigint, name string, `a.b` string")
    name = sinks.report_name("activity", admin_id=7, moment=datetime(2020, 1, 2, 3, 4, 5))
    assert name.startswith("activity-user7-20200102030405-")
    assert sinks.report_name("activity", 7, (4,)).startswith("activity-user4-")
    path = sinks.write_report(report, str(tmp_path), name)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert lines == [{"user_id": 1, "name": "á", "a.b": None}]
    assert sinks.sample(rows([(i,) for i in range(9)], "i int")).count() == 5


def test_lake_names_and_types(spark, rows):
    users = rows(
        [(1, "t1", "Ana", 1, 0, datetime(2020, 1, 2), "x")],
        "id int, id_cliente string, texto_nome_completo string, flag_status int, flag_padrao int, data_cadastro timestamp, coluna_nova string",
    )
    got = lake.from_lake("users", users)
    assert got.dtypes == [
        ("user_id", "bigint"), ("tenant_id", "string"), ("full_name", "string"), ("is_active", "boolean"), ("is_default", "boolean"),
        ("created_at", "timestamp_ntz"),
    ]
    assert got.first().created_at == datetime(2020, 1, 2)
    progress = rows([(5, 3, 2, Decimal("1.50"))], "id int, numero_total_rodadas int, numero_total_rodadas_em_andamento int, numero_pontuacao decimal(9,2)")
    assert lake.from_lake("track_progress", progress).columns == ["progress_id", "total_modules", "in_progress_modules", "score"]
    roles = rows([(1, "RD   ")], "id_usuario int, id_entidade_tipo string")
    assert lake.from_lake("roles", roles).first().entity_type == "RD"


def test_lake_covers_the_columns_the_library_reads(spark):
    """Every fixture column of the attribute, label and content tables can come from the lake."""
    offered = set(lake.COMMON.values()) | {v for s in lake.SPECIAL.values() for v in s.values()} | {k for _, k in lake.LAKE_TABLES.values() if k}
    for table, (ddl, _) in platform_fixture.TABLES.items():
        names = {part.split()[0] for part in ddl.replace("(10,2)", "").replace("(18,2)", "").split(",")}
        assert names <= offered, (table, names - offered)


def test_platform_filters_tenant_tables_only(spark):
    platform = platform_fixture.build(spark).for_tenant("t2")
    assert {r.tenant_id for r in platform.users.collect()} == {"t2"}
    assert platform.label_texts.count() == 6


def test_stage_writes_once(spark, rows):
    stage, calls = Stage(spark, "test"), []

    def build():
        calls.append(1)
        return rows([(1, "a"), (2, "b")], "i int, tenant_id string")

    first = stage.keep("t", build, ("tenant_id",))
    second = stage.keep("t", build, ("tenant_id",))
    assert len(calls) == 1 and first is second and sorted(r.i for r in second.collect()) == [1, 2]
    assert "FileScan parquet" in second._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_the_session():
    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    assert shared_folder(session("s3a://team/checkpoints/", "yarn")) == "s3a://team/checkpoints"
    with pytest.raises(RuntimeError):
        shared_folder(session(None, "yarn"))


def test_text_keys_that_are_not_numbers(spark, rows):
    from lumenpath.functions.exprs import to_id

    got = rows([("12",), ("api",), ("",), (None,)], "s string").select(to_id(F.col("s")).alias("i")).collect()
    assert [r.i for r in got] == [12, None, None, None]
