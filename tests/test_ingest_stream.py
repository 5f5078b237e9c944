"""The stream of archives and its sink: restarts, failures, time zones, equal names."""

import os

import duckdb
import pytest
from samples import FACTS, write_month, write_zip

import __spark_entry__ as driver
from registra.config import text_schema
from registra.sinks.bronze import land_archives, read_bronze
from registra.sources.archive import expand_archives
from registra.sources.listing import list_archives
from registra.streaming.ingest import (
    BronzeSink,
    arriving_archives,
    ingest_archives,
    landed_archives,
    start_ingest,
)
from registra.streaming.source import ArchiveListingReader

SCHEMA = text_schema(21)
MONTH = "estabelecimentos_2025-12"


def counts(spark, bronze):
    rows = read_bronze(spark, bronze, SCHEMA, "estabelecimentos", "2025-12")
    return dict(map(tuple, rows.groupBy("archive").count().collect()))


class Stop(Exception):
    pass


def stopped(spark, folder, checkpoint, sink):
    with pytest.raises(Exception, match="Stop"):
        start_ingest(spark, folder, checkpoint, sink, "E").awaitTermination()


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_failure_around_landing_gives_each_row_once(spark, tmp_path, moment):
    root, bronze, checkpoint = write_month(tmp_path / "in"), str(tmp_path / "b"), str(tmp_path / "c")
    folder = f"{root}/{MONTH}"

    def failing(*args, **kwargs):
        if moment == "after":  # landed, but not recorded
            land_archives(*args, **kwargs)
        raise Stop("Stop")

    stopped(spark, folder, checkpoint, BronzeSink(bronze, checkpoint, SCHEMA, land=failing))
    assert landed_archives(spark, checkpoint).count() == 0
    # What arrives between the failure and the restart is in a later batch.
    write_zip(tmp_path / "in" / MONTH / "E7.zip", {"late": FACTS[0]})
    result = ingest_archives(spark, folder, bronze, checkpoint, SCHEMA, "E")
    assert result.archives == 3 and counts(spark, bronze) == {"E0.zip": 6, "E1.zip": 5, "E7.zip": 1}
    assert landed_archives(spark, checkpoint).count() == 3
    assert ingest_archives(spark, folder, bronze, checkpoint, SCHEMA, "E").archives == 0


def test_a_batch_that_is_recorded_is_not_landed_again(spark, tmp_path):
    root, checkpoint = write_month(tmp_path / "in"), str(tmp_path / "c")
    listing = list_archives(spark, f"{root}/{MONTH}")
    sink = BronzeSink(str(tmp_path / "b"), checkpoint, SCHEMA, files_per_batch=1)
    sink(listing, 5)
    assert (sink.archives, sink.rows) == (2, 11)

    def never(*args, **kwargs):
        raise AssertionError("landed twice")

    again = BronzeSink(str(tmp_path / "b"), checkpoint, SCHEMA, files_per_batch=1, land=never)
    again(listing, 5)
    assert (again.archives, again.rows) == (0, 0)


def test_offsets_are_logged_entries_and_do_not_change(tmp_path):
    root = write_month(tmp_path / "in")
    options = {"path": f"{root}/{MONTH}", "log": str(tmp_path / "log"), "contains": "E"}
    reader = ArchiveListingReader(options)
    assert reader.initialOffset() == {"log": 0}
    assert reader.latestOffset() == reader.latestOffset() == {"log": 1}

    def rows(start, end):
        parts = reader.partitions({"log": start}, {"log": end})
        return sorted(r["below"] for p in parts for b in reader.read(p) for r in b.to_pylist())

    assert rows(0, 1) == ["E0.zip", "E1.zip"] and rows(1, 1) == []
    target = tmp_path / "in" / MONTH / "E1.zip"
    old = target.stat()
    os.utime(target, ns=(old.st_atime_ns, old.st_mtime_ns + 10**9))  # same length, other time
    assert reader.latestOffset() == {"log": 2} and rows(1, 2) == ["E1.zip"]
    os.utime(target, ns=(old.st_atime_ns, old.st_mtime_ns))  # back again
    restarted = ArchiveListingReader(options)
    assert restarted.latestOffset() == {"log": 3}
    assert rows(0, 1) == ["E0.zip", "E1.zip"] and rows(0, 3) == ["E0.zip", "E1.zip", "E1.zip", "E1.zip"]
    (tmp_path / "log" / "000000000004.parquet.tmp").write_bytes(b"half")  # a write that was cut off
    assert ArchiveListingReader(options).latestOffset() == {"log": 3}


def test_missing_folder_and_long_running_query(spark, tmp_path):
    folder, bronze, checkpoint = str(tmp_path / "in" / MONTH), str(tmp_path / "b"), str(tmp_path / "c")
    assert ingest_archives(spark, folder, bronze, checkpoint, SCHEMA).archives == 0
    sink = BronzeSink(bronze, checkpoint, SCHEMA)
    query = start_ingest(spark, folder, checkpoint, sink, every="0 seconds")
    try:
        for name, rows in (("E0.zip", 2), ("E1.zip", 3), ("E0.zip", 1)):
            write_zip(tmp_path / "in" / MONTH / name, {"m": "".join(FACTS[:rows])})
            query.processAllAvailable()
    finally:
        query.stop()
    assert counts(spark, bronze) == {"E0.zip": 1, "E1.zip": 3}


ZONES = ["UTC", "Etc/UTC", "America/Sao_Paulo"]
INGESTS = ["scan_archive_all_names", "scan_archive_last_member", "stream_files_once",
           "ingest_emptied_archive", "ingest_replaced_archive", "ingest_same_names"]


@pytest.mark.parametrize("name", INGESTS)
@pytest.mark.parametrize("zone", ZONES)
def test_ingest_in_any_time_zone(spark, zone, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("lineitem", "events"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = driver.queries()[name](spark, sf).toArrow()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    expected = con.sql(driver.oracle_sql()[name]).to_arrow_table()
    key = [(n, "ascending") for n in sorted(expected.schema.names)]
    assert got.select([k for k, _ in key]).sort_by(key).to_pylist() == expected.select(
        [k for k, _ in key]
    ).sort_by(key).to_pylist()


def test_listing_has_the_time_of_the_file_in_any_zone(spark, tmp_path):
    write_zip(tmp_path / "in" / MONTH / "E0.zip", {"m": FACTS[0]})
    os.utime(tmp_path / "in" / MONTH / "E0.zip", ns=(0, 1_700_000_000_123_456_000))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ZONES:
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = list_archives(spark, str(tmp_path / "in")).selectExpr(
                "unix_micros(modificationTime) as t", "below"
            ).first()
            assert tuple(row) == (1_700_000_000_123_456, f"{MONTH}/E0.zip")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_equal_names_in_two_folders_stay_apart(spark, tmp_path):
    folders = [tmp_path / "in" / lot / MONTH for lot in ("lot1", "lot2")]
    for files in (1000, 1):  # in one part and in one part each
        bronze, checkpoint = str(tmp_path / f"b{files}"), str(tmp_path / f"c{files}")
        for folder, rows in zip(folders, (3, 5)):
            write_zip(folder / "E1.zip", {"m": "".join(FACTS[:rows])})
        ingest_archives(spark, str(tmp_path / "in"), bronze, checkpoint, SCHEMA, files_per_batch=files)
        assert counts(spark, bronze) == {"lot1/E1.zip": 3, "lot2/E1.zip": 5}
        write_zip(folders[0] / "E1.zip", {"m": "\n"})
        ingest_archives(spark, str(tmp_path / "in"), bronze, checkpoint, SCHEMA, files_per_batch=files)
        assert counts(spark, bronze) == {"lot2/E1.zip": 5}


def test_last_member_wins_in_its_own_month_only(spark, tmp_path):
    for month in ("estabelecimentos_2025-11", MONTH):
        for archive, rows in (("E1.zip", 1), ("E2.zip", 2)):
            write_zip(tmp_path / month / archive, {"same": "".join(FACTS[:rows]), archive: FACTS[0]})
    listing = list_archives(spark, str(tmp_path)).selectExpr("path", "split(below, '/')[0] as month")
    lines = expand_archives(listing, member_conflict="last", within=["month"])
    got = {tuple(r) for r in lines.groupBy("month", "member").count().collect()}
    own = {(m, a, 1) for m in ("estabelecimentos_2025-11", MONTH) for a in ("E1.zip", "E2.zip")}
    assert got == own | {("estabelecimentos_2025-11", "same", 2), (MONTH, "same", 2)}
    everywhere = expand_archives(listing.select("path"), member_conflict="last")
    assert everywhere.filter("member = 'same'").count() == 2
    with pytest.raises(ValueError, match="member_conflict"):
        expand_archives(listing, member_conflict="first")


def test_arriving_archives_follow_their_log(spark, tmp_path):
    root = write_month(tmp_path / "in")
    stream = arriving_archives(spark, f"{root}/{MONTH}", "E", log=str(tmp_path / "log"))
    for _ in range(2):
        query = (
            stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
