import dataclasses
import json

import pytest
from pyspark.sql import functions as F
from samples import FACTS, HITS, LOOKUP, LOOKUP_REPEATS, SILVER, write_month, write_zip

from registra import __main__ as job
from registra.config import ColumnMap, RunConfig, text_schema
from registra.plans.medallion import read_silver, run
from registra.session import (
    S3A_PACKAGE,
    object_store_builder,
    qualify,
    s3a_conf,
    store_options,
    work_folder,
)
from registra.sinks.bronze import keyed_lines, land_archives, read_bronze
from registra.sinks.parquet import (
    SKIPPED_EMPTY,
    SKIPPED_GUARD,
    WRITTEN,
    overwrite_partitions,
    partition_folder,
)
from registra.sources.archive import read_archives
from registra.sources.delimited import parse_lines
from registra.sources.filesystem import list_files, resolve
from registra.sources.listing import (
    complete_files,
    list_archives,
    list_objects,
    manifest,
    routed,
)
from registra.streaming.ingest import arriving_archives, ingest_archives

MONTH = "estabelecimentos_2025-12"


def month_rows(spark, month, n):
    return spark.range(n).withColumn("ref_month", F.lit(month))


def by_month(spark, path):
    stored = spark.read.schema("id long, ref_month string").parquet(path)
    return dict(map(tuple, stored.groupBy("ref_month").count().collect()))


def test_month_overwrite(spark, tmp_path):
    path = str(tmp_path / "silver")
    for month, n in (("2025-11", 3), ("2025-12", 9), ("2025-12", 4)):
        result = overwrite_partitions(month_rows(spark, month, n), path, ["ref_month"])
        assert (result.status, result.rows) == (WRITTEN, n)
    assert by_month(spark, path) == {"2025-11": 3, "2025-12": 4}


def empty_months(spark):
    rows = month_rows(spark, "2025-12", 5)
    nothing = rows.filter("id > 9")
    yield month_rows(spark, "2025-12", 0)
    yield nothing
    yield rows.limit(0)
    yield spark.createDataFrame([], rows.schema)
    yield rows.join(nothing.select("id"), "id")
    yield rows.join(F.broadcast(nothing.select("id")), "id")
    yield rows.repartition(4, "id").filter("id > 9").repartition(2, "ref_month")


def test_empty_result_keeps_the_last_data(spark, tmp_path):
    path = str(tmp_path / "silver")
    overwrite_partitions(month_rows(spark, "2025-12", 4), path, ["ref_month"])
    for empty in empty_months(spark):
        for rebalance in (False, True):
            result = overwrite_partitions(empty, path, ["ref_month"], rebalance)
            assert (result.status, result.rows) == (SKIPPED_EMPTY, 0)
    assert by_month(spark, path) == {"2025-12": 4}


def test_rebalance_keeps_rows_and_writes_few_files(spark, tmp_path):
    months = F.concat(F.lit("2025-0"), (F.col("id") % 9 + 1).cast("string"))
    rows = spark.range(0, 9000, 1, 32).withColumn("ref_month", months)
    path = tmp_path / "silver"
    assert overwrite_partitions(rows, str(path), ["ref_month"], rebalance=True).rows == 9000
    assert len(list(path.rglob("*.parquet"))) <= 18
    assert by_month(spark, str(path)) == {f"2025-0{i}": 1000 for i in range(1, 10)}


def test_sorted_files_keep_rows(spark, tmp_path):
    rows = month_rows(spark, "2025-12", 1000).orderBy(F.rand(1)).repartition(3)
    path = str(tmp_path / "silver")
    assert overwrite_partitions(rows, path, ["ref_month"], sort_by=["id"]).rows == 1000
    stored = spark.read.parquet(path).withColumn("file", F.input_file_name())
    for (file,) in stored.select("file").distinct().collect():
        ids = [r["id"] for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)
    assert by_month(spark, path) == {"2025-12": 1000}


def landing(spark, folder):
    return parse_lines(keyed_lines(list_objects(spark, folder)), text_schema(21))


def test_landing_again_replaces_only_that_archive(spark, tmp_path):
    root = write_month(tmp_path / "in")
    bronze = str(tmp_path / "bronze")
    schema = text_schema(21)

    def per_archive():
        rows = read_bronze(spark, bronze, schema, "estabelecimentos", "2025-12")
        return dict(map(tuple, rows.groupBy("archive").count().collect()))

    for _ in range(2):
        assert land_archives(list_objects(spark, f"{root}/{MONTH}"), bronze, schema).rows == 11
        assert per_archive() == {"E0.zip": 6, "E1.zip": 5}
    write_zip(tmp_path / "in" / MONTH / "E1.zip", {"part1": FACTS[6]})
    land_archives(list_objects(spark, f"{root}/{MONTH}/E1.zip"), bronze, schema)
    assert per_archive() == {"E0.zip": 6, "E1.zip": 1}


def test_rows_without_a_month_are_refused(spark, tmp_path):
    write_zip(tmp_path / "loose" / "E0.zip", {"part0": FACTS[0]})
    with pytest.raises(Exception, match="yyyy-mm"):
        landing(spark, str(tmp_path / "loose")).count()


def test_listing(spark, tmp_path):
    root = write_month(tmp_path / "in")
    archives = routed(list_objects(spark, root)).select("dataset", "ref_month", "name")
    assert sorted(map(tuple, archives.collect())) == [
        ("estabelecimentos", "2025-11", "E0.zip"),
        ("estabelecimentos", "2025-12", "E0.zip"),
        ("estabelecimentos", "2025-12", "E1.zip"),
        ("municipios", "2025-12", "M.zip"),
    ]
    everything = list_objects(spark, root, suffix="")
    assert everything.count() == 6
    names = {r["name"] for r in manifest(complete_files(everything)).collect()}
    assert names == {"E0.zip", "E1.zip", "M.zip", "notes.txt"}
    settled = manifest(complete_files(everything, rule="folder")).collect()
    assert sorted(map(tuple, settled)) == [("E0.zip", 0), ("M.zip", 0)]
    with pytest.raises(ValueError):
        complete_files(everything, rule="other")


def test_listing_reads_no_contents(spark, tmp_path):
    root = write_month(tmp_path / "in")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1")
    try:
        assert list_objects(spark, root).count() == 4
        assert len(list_objects(spark, root).collect()) == 4
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_stream_lands_each_file_once(spark, tmp_path):
    inbox, bronze = tmp_path / "in", str(tmp_path / "bronze")
    root = write_month(inbox)
    progress = str(tmp_path / "progress")
    args = (spark, f"{root}/{MONTH}", bronze, progress, text_schema(21))

    def landed():
        return read_bronze(spark, bronze, text_schema(21), "estabelecimentos", "2025-12")

    def batch_equal():
        batch = landing(spark, f"{root}/{MONTH}").drop("member", "dataset", "ref_month", "archive")
        stream = landed().select(*batch.columns)
        return batch.exceptAll(stream).isEmpty() and stream.exceptAll(batch).isEmpty()

    ingest_archives(*args, files_per_batch=1)
    assert landed().count() == 11 and batch_equal()
    files = sorted((tmp_path / "bronze").rglob("*.parquet"))
    ingest_archives(*args)
    assert sorted((tmp_path / "bronze").rglob("*.parquet")) == files
    write_zip(inbox / MONTH / "E3.zip", {"late": "".join(FACTS[:2])})
    ingest_archives(*args)
    assert landed().count() == 13 and batch_equal()


def test_stream_reads_no_contents_to_list(spark, tmp_path):
    stream = arriving_archives(spark, write_month(tmp_path / "in"))
    assert stream.isStreaming and stream.columns == ["path", "length"]


@pytest.fixture()
def cfg(tmp_path):
    root = write_month(tmp_path / "archives")
    return RunConfig(root, str(tmp_path / "bronze"), str(tmp_path / "silver"), "2025-12")


def test_run(spark, cfg):
    result = run(spark, cfg)
    assert (result.facts.rows, result.lookup.rows) == (11, 3)
    assert (result.silver.status, result.silver.rows) == (WRITTEN, len(SILVER))
    assert {tuple(r) for r in result.gold.collect()} == {
        ("1", 3, "matriz"), ("2", 2, "filial"), (None, 1, "unknown")
    }
    stored = read_silver(spark, cfg, text_schema(21))
    assert {r["_c0"] for r in stored.collect()} == SILVER
    assert len(stored.columns) == 26
    again = run(spark, cfg)
    assert read_silver(spark, cfg, text_schema(21)).count() == len(SILVER)
    assert again.silver == result.silver


def test_run_stores_gold_by_month(spark, cfg, tmp_path):
    stored = dataclasses.replace(cfg, gold=str(tmp_path / "gold"))
    for month in ("2025-12", "2025-11", "2025-12"):
        write_zip(tmp_path / "archives" / "municipios_2025-11" / "M.zip", {"M": LOOKUP})
        result = run(spark, dataclasses.replace(stored, ref_month=month, width=21))
        assert sum(r["n"] for r in result.gold.collect()) == result.silver.rows
    table = spark.read.parquet(stored.gold)
    counts = table.groupBy(F.col("ref_month").cast("string").alias("m")).agg(F.sum("n"))
    assert sorted(n for _, n in counts.collect()) == [1, len(SILVER)]


def test_job_arguments(spark, cfg, tmp_path, capsys):
    paths = ["--archives", cfg.archives, "--bronze", cfg.bronze]
    job.main(["run", *paths, "--silver", cfg.silver, "--month", "2025-12", "--city", "7107"], spark)
    assert json.loads(capsys.readouterr().out) == {
        "facts": 11, "lookup": 3, "silver": len(SILVER), "status": WRITTEN,
        "gold": {"matriz": 3, "filial": 2, "unknown": 1},
    }
    job.main(["run", *paths, "--silver", cfg.silver, "--month", "2025-12", "--all-cities"], spark)
    assert json.loads(capsys.readouterr().out)["silver"] == len(SILVER) + 1


def test_every_option_of_a_job(spark, cfg, tmp_path, capsys):
    paths = ["--archives", cfg.archives, "--bronze", cfg.bronze, "--silver", cfg.silver]
    month = ["--month", "2025-12", "--gold", str(tmp_path / "gold")]
    more = ["--search", "7107", "--gold-by-city", "--label", "1=head", "--label", "2=branch"]
    job.main(["run", *paths, *month, *more], spark)
    assert json.loads(capsys.readouterr().out) == {
        "facts": 11, "lookup": 3, "silver": len(SILVER), "status": WRITTEN,
        "gold": {"head": 3, "branch": 2, "unknown": 1},
        "n_lookup": 1, "n_search": len(HITS), "n_final": len(SILVER),
    }
    stored = spark.read.parquet(str(tmp_path / "gold"))
    assert {(r.municipio_cod, r.municipio_nome) for r in stored.collect()} == {(7107, "SÃO PAULO")}
    args = job.arguments(["refine", "--bronze", "b", "--silver", "s", "--month", "2025-12", "--width", "3",
                          "--municipality-column", "_c1", "--status-column", "_c2", "--kind-column", "_c0",
                          "--active", "8", "--unique-lookup"])
    made = job.config(args)
    assert made.columns == ColumnMap("_c1", "_c2", "_c0") and made.active == 8 and made.unique_lookup
    assert made.search is None and made.member_conflict == "all" and made.kind_labels["1"] == "matriz"
    with pytest.raises(SystemExit):
        job.main(["run", *paths, *month, "--label", "head"], spark)


def test_ingest_then_refine(spark, cfg, tmp_path, capsys):
    """Both datasets landed by their own stream, then the month refined from bronze."""
    paths = ["--archives", cfg.archives, "--bronze", cfg.bronze, "--checkpoint"]
    for _ in range(2):
        facts = ["--contains", "E", "--width", "21"]
        job.main(["ingest", *paths, str(tmp_path / "facts"), *facts], spark)
        job.main(["ingest", *paths, str(tmp_path / "m"), "--contains", "M", "--lookup"], spark)
        landed = spark.read.schema("dataset string, ref_month string").parquet(cfg.bronze)
        assert sorted(map(tuple, landed.groupBy("dataset", "ref_month").count().collect())) == [
            ("estabelecimentos", "2025-11", 1),
            ("estabelecimentos", "2025-12", 11),
            ("municipios", "2025-12", 3),
        ]
    month = ["--bronze", cfg.bronze, "--silver", cfg.silver, "--month", "2025-12", "--width", "21"]
    job.main(["refine", *month], spark)
    assert json.loads(capsys.readouterr().out) == {
        "status": WRITTEN, "silver": len(SILVER), "gold": {"matriz": 3, "filial": 2, "unknown": 1}
    }
    with pytest.raises(SystemExit):
        job.main(["refine", *month, "--city", "7107", "--all-cities"], spark)


def test_run_with_business_names(spark, cfg):
    named = dataclasses.replace(cfg, width=21, names={"_c0": "codigo_basico", "_c3": "kind_flag"})
    result = run(spark, named)
    assert sum(r["n"] for r in result.gold.collect()) == len(SILVER)
    stored = read_silver(spark, named, text_schema(21), "2025-12")
    assert {r["codigo_basico"] for r in stored.collect()} == SILVER


def test_run_guard(spark, cfg, tmp_path):
    guard = dataclasses.replace(cfg, guard="any_column")
    assert run(spark, guard).silver.rows == len(SILVER)
    write_month(tmp_path / "archives", facts=[FACTS[1], FACTS[5]])
    assert run(spark, guard).silver.status == SKIPPED_GUARD
    assert read_silver(spark, cfg, text_schema(21)).count() == len(SILVER)
    assert run(spark, cfg).silver.rows == 2
    for wrong in ({"guard": "other"}, {"guard": "any_column", "codes": None}):
        with pytest.raises(ValueError):
            run(spark, dataclasses.replace(cfg, **wrong))


def test_run_with_an_empty_result(spark, cfg):
    run(spark, cfg)
    empty = run(spark, dataclasses.replace(cfg, active=99))
    assert (empty.silver.status, empty.gold) == (SKIPPED_EMPTY, None)
    assert read_silver(spark, cfg, text_schema(21)).count() == len(SILVER)


def test_run_forgets_archives_that_are_gone(spark, cfg, tmp_path):
    run(spark, cfg)
    write_zip(tmp_path / "archives" / MONTH / "E1.zip", {"part1": ""})
    result = run(spark, cfg)
    assert result.facts.rows == 6 and result.silver.rows == 4


def test_missing_archives_leave_what_was_landed(spark, cfg, tmp_path):
    run(spark, cfg)
    gone = dataclasses.replace(
        cfg, archives=str(tmp_path / "elsewhere"), width=21, on_missing="empty"
    )
    result = run(spark, gone)
    assert result.facts.rows == 0 and result.silver.status == SKIPPED_EMPTY
    landed = read_bronze(spark, cfg.bronze, text_schema(21), "estabelecimentos", "2025-12")
    assert landed.count() == 11
    assert read_silver(spark, cfg, text_schema(21)).count() == len(SILVER)


def test_run_without_input(spark, cfg):
    absent = dataclasses.replace(cfg, ref_month="2024-01", width=21)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run(spark, absent)
    result = run(spark, dataclasses.replace(absent, on_missing="empty"))
    assert result.facts.rows == result.lookup.rows == result.silver.rows == 0
    unsized = run(spark, dataclasses.replace(absent, width=None, on_missing="empty"))
    assert unsized.facts.rows == unsized.silver.rows == 0
    with pytest.raises(FileNotFoundError):
        run(spark, dataclasses.replace(absent, width=None))


def test_replaced_and_emptied_archives_are_landed_again(spark, tmp_path):
    inbox, bronze = tmp_path / "in", str(tmp_path / "bronze")
    root = write_month(inbox)
    args = (spark, f"{root}/{MONTH}", bronze, str(tmp_path / "progress"), text_schema(21))

    def landed():
        rows = read_bronze(spark, bronze, text_schema(21), "estabelecimentos", "2025-12")
        return {r["archive"]: r["count"] for r in rows.groupBy("archive").count().collect()}

    assert ingest_archives(*args).archives > 0
    before = landed()
    write_zip(inbox / MONTH / "E1.zip", {"part1": "".join(FACTS[:1])})
    assert ingest_archives(*args).archives == 1
    assert landed() == before | {"E1.zip": 1}
    write_zip(inbox / MONTH / "E1.zip", {"part1": ""})
    assert ingest_archives(*args).archives == 1
    assert landed() == {k: v for k, v in before.items() if k != "E1.zip"}
    assert ingest_archives(*args).archives == 0


def test_both_routes_take_archives_of_any_name(spark, tmp_path):
    for name in ("_E.zip", "F.zip", ".G.zip", "_sub/H.zip"):
        write_zip(tmp_path / "in" / MONTH / name, {"m": "".join(FACTS[:2])})
    folder = f"{tmp_path}/in/{MONTH}"
    names = {r["path"].rpartition("/")[2] for r in list_archives(spark, folder).collect()}
    assert names == {"_E.zip", "F.zip", ".G.zip", "H.zip"}
    assert read_archives(spark, folder).count() == 8


def test_silver_is_one_file_for_few_rows(spark, cfg, tmp_path):
    for i in range(30):
        write_zip(tmp_path / "archives" / MONTH / f"X{i}.zip", {"m": "".join(FACTS)})
    assert run(spark, cfg).silver.rows > len(SILVER)
    assert len(list((tmp_path / "silver").rglob("*.parquet"))) <= 2


def test_partition_folder_is_escaped_as_spark_does(spark, tmp_path):
    odd = "a:b%c=[1]'x\"y z.zip"
    spark.range(1).select("id", F.lit(odd).alias("archive")).write.partitionBy("archive").parquet(
        f"{tmp_path}/t"
    )
    assert (tmp_path / "t" / partition_folder(["archive"], [odd])).is_dir()


def test_default_file_system_is_asked_of_hadoop(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    hadoop.set("fs.defaultFS", "hdfs://nn:8020")
    try:
        assert qualify(spark, "/data/x") == "hdfs://nn:8020/data/x"
    finally:
        hadoop.set("fs.defaultFS", before)
    assert qualify(spark, "/data/x") == "/data/x"


def test_run_can_refuse_repeated_codes(spark, cfg, tmp_path):
    strict = dataclasses.replace(cfg, unique_lookup=True)
    assert run(spark, strict).silver.rows == len(SILVER)
    write_zip(tmp_path / "archives" / "municipios_2025-12" / "M.zip", {"M": LOOKUP + LOOKUP_REPEATS})
    with pytest.raises(ValueError, match="7107"):
        run(spark, strict)
    assert run(spark, cfg).silver.rows == 3 * len(SILVER)


def test_object_store_settings():
    env = {"AWS_ENDPOINT_URL": "http://store:9000", "AWS_ACCESS_KEY_ID": "k",
           "AWS_SECRET_ACCESS_KEY": "s"}
    conf = s3a_conf(env)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.impl"] == "org.apache.hadoop.fs.s3a.S3AFileSystem"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert not any("key" in k for k in s3a_conf({}))

    class Builder(dict):
        def config(self, key, value):
            self[key] = value
            return self

    assert object_store_builder(Builder(), env) == conf
    fetched = object_store_builder(Builder(), env, S3A_PACKAGE)
    assert fetched["spark.jars.packages"] == S3A_PACKAGE
    assert store_options(env) == {"endpoint": "store:9000", "scheme": "http"}
    assert store_options({"AWS_REGION": "sa-east-1"}) == {"region": "sa-east-1"}
    assert store_options({}) == {}


def test_paths_and_work_folder(spark, tmp_path):
    assert resolve("/a b/c#%20.zip")[1:] == ("/a b/c#%20.zip", "")
    assert resolve("file:/a/b")[1:] == ("/a/b", "file:")
    assert resolve("file:///a/b")[1:] == ("/a/b", "file:")
    store, path, prefix = resolve("s3a://bucket/k/x.zip", {"endpoint": "localhost:1", "region": "us-east-1"})
    assert (store.type_name, prefix + path) == ("s3", "s3a://bucket/k/x.zip")
    write_zip(tmp_path / "b.zip", {})
    write_zip(tmp_path / "a" / "a.zip", {})
    (tmp_path / "a.txt").write_text("")
    assert list_files(str(tmp_path), ".zip") == [f"{tmp_path}/a/a.zip", f"{tmp_path}/b.zip"]
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two and one.startswith(f"{shared}/x-")
    assert qualify(spark, "/p") == "/p" and qualify(spark, "s3a://b/p") == "s3a://b/p"
