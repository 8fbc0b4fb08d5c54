from __future__ import annotations

import datetime as dt
import glob
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerlake.operators import quality, reconcile
from ledgerlake.session import scratch_dir
from ledgerlake.sinks import publish, warehouse
from ledgerlake.sinks.layers import write_layer
from ledgerlake.sources.relational import ParquetSource, UnknownTable
from ledgerlake.spec import TableSpec
from tests.conftest import rows

SPEC = TableSpec("t", "id BIGINT, amount DECIMAL(18,2), note STRING", nullable=("note",))


def table(spark, *lines):
    return spark.createDataFrame([(i, Decimal(a), n) for i, a, n in lines], SPEC.ddl)


@pytest.fixture
def sample(spark):
    return table(spark, (1, "1.00", "a"), (2, "2.00", None), (3, "3.00", "c"))


def files(path, kind="parquet"):
    return glob.glob(f"{path}/**/*.{kind}", recursive=True)


def test_write_layer_counts_and_overwrites(spark, sample, folder):
    assert write_layer(sample, f"{folder}/t") == 3
    assert write_layer(sample.filter("id = 1"), f"{folder}/t") == 1
    assert rows(spark.read.parquet(f"{folder}/t"), "id") == [(1,)]


def test_an_empty_layer_keeps_its_schema(spark, sample, folder):
    assert write_layer(sample.limit(0), f"{folder}/t") == 0
    assert spark.read.parquet(f"{folder}/t").columns == SPEC.columns


def test_single_file_is_an_option(spark, folder):
    many = spark.range(0, 1000, 1, 7)
    write_layer(many, f"{folder}/many")
    assert write_layer(many, f"{folder}/one", single_file=True) == 1000
    assert len(files(f"{folder}/many")) > 1 and len(files(f"{folder}/one")) == 1


def test_clustered_write_has_one_file_per_partition_value(spark, folder):
    spread = spark.range(0, 1000, 1, 7).withColumn("day", F.col("id") % 5)
    write_layer(spread, f"{folder}/t", partition_by=["day"], cluster_by=["day"])
    assert len(files(f"{folder}/t")) == 5


# --------------------------------------------------------------------------------- publish
def test_publish_and_read_back(spark, sample, folder):
    publish.publish({"a": sample, "b": sample.filter("id > 1")}, folder, run_id="r1")
    assert rows(publish.read_published(spark, folder, "a")) == rows(sample)
    assert rows(publish.latest_manifest(spark, folder), "run_id", "table", "n_rows") == [("r1", "a", 3), ("r1", "b", 2)]
    assert publish.verify_published(spark, folder).isEmpty()


def test_readers_see_the_last_complete_publication(spark, sample, folder):
    publish.publish({"a": sample, "b": sample}, folder)
    empty = sample.limit(0)
    with pytest.raises(publish.PublishError, match="b: the table is empty"):
        publish.publish({"a": sample.filter("id = 1"), "b": empty}, folder)
    assert publish.read_published(spark, folder, "a").count() == 3
    publish.publish({"a": sample.filter("id = 1"), "b": sample}, folder)
    assert publish.read_published(spark, folder, "a").count() == 1


def test_changed_files_are_noticed(spark, sample, folder):
    publish.publish({"a": sample}, folder, run_id="r1")
    sample.withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)")).write.mode("overwrite").parquet(f"{folder}/a/run=r1")
    assert rows(publish.verify_published(spark, folder), "check", "table") == [("published", "a")]


def test_unknown_table_was_not_published(spark, sample, folder):
    publish.publish({"a": sample}, folder)
    with pytest.raises(publish.PublishError, match="z has not been published"):
        publish.read_published(spark, folder, "z")


def test_digest_ignores_order_and_sees_every_value(spark, sample):
    digest = lambda frame: publish.fingerprint(frame, "t").first()["digest"]
    assert digest(sample) == digest(sample.orderBy(F.desc("id")).repartition(3))
    assert digest(sample) != digest(sample.withColumn("note", F.coalesce("note", F.lit(""))))
    assert digest(sample) != digest(sample.unionByName(sample.limit(1)))
    assert digest(sample.limit(0)) == 0


@pytest.mark.parametrize("one, other", [((None, "x"), ("\\N", "x")), (("a\x1fb", "c"), ("a", "b\x1fc")), (("1:a,", ""), ("1:a", ",")), (("-", None), (None, "-")), (("", None), (None, ""))])
def test_digest_keeps_nulls_and_fields_apart(spark, one, other):
    digest = lambda values: publish.fingerprint(spark.createDataFrame([values], "a STRING, b STRING"), "t").first()["digest"]
    assert digest(one) != digest(other) and digest(one) == digest(one)


def test_a_changed_byte_a_missing_and_a_new_file_are_found(spark, sample, folder):
    publish.publish({"a": sample.repartition(2), "b": sample.repartition(2)}, folder, run_id="r1")
    assert publish.file_problems(spark, folder).isEmpty()
    found = lambda: sorted((r.table, r.detail) for r in publish.file_problems(spark, folder).collect())
    for checksum in glob.glob(f"{folder}/*/run=r1/.*.crc"):  # a local file system would notice by itself
        os.remove(checksum)
    one, two = sorted(glob.glob(f"{folder}/a/run=r1/*.parquet"))[:2]
    with open(one, "r+b") as file:
        file.seek(10)
        byte = file.read(1)
        file.seek(10)
        file.write(bytes([byte[0] ^ 1]))
    assert found() == [("a", "file has other bytes")]
    shutil.copy(two, f"{folder}/b/run=r1/part-copy.parquet")
    with open(two, "ab") as file:
        file.write(b"x")
    assert found() == [("a", "file has another size"), ("a", "file has other bytes"), ("b", "file is not listed")]
    os.remove(glob.glob(f"{folder}/b/run=r1/part-0*.parquet")[0])
    assert ("b", "file is missing") in found()


def test_old_publications_expire_and_readers_stay_right(spark, sample, folder):
    for n in (1, 2, 3):
        publish.publish({"a": sample.filter(f"id <= {n}"), "b": sample}, folder, run_id=f"r{n}")
    reading = publish.read_published(spark, folder, "a")
    assert publish.expire(spark, folder, keep=2) == []  # none is a week old
    assert publish.expire(spark, folder, keep=2, older_than=dt.timedelta(0)) == ["r1"]
    assert sorted(os.listdir(f"{folder}/a")) == ["run=r2", "run=r3"] and len(files(f"{folder}/_manifest", "json")) == 1
    assert rows(reading) == rows(publish.read_published(spark, folder, "a")) == rows(sample)
    assert publish.verify_published(spark, folder).isEmpty() and publish.file_problems(spark, folder).isEmpty()
    assert publish.expire(spark, folder, keep=0, older_than=dt.timedelta(0)) == ["r2"]  # the last one always stays
    assert publish.expire(spark, folder, keep=1, older_than=dt.timedelta(0)) == []
    publish.publish({"a": sample, "b": sample}, folder, run_id="r4")
    assert {r.run_id for r in publish.latest_manifest(spark, folder).collect()} == {"r4"}


def test_an_expiry_cut_short_changes_no_reader(spark, sample, folder):
    publish.publish({"a": sample}, folder, run_id="r1")
    line = glob.glob(f"{folder}/_manifest/*.json")[0]
    shutil.copy(line, line.replace("part-", "part-again-"))  # the rewritten list stands beside the old one
    assert publish.latest_manifest(spark, folder).count() == 1 and rows(publish.read_published(spark, folder, "a")) == rows(sample)


def test_plan_lists_rows_and_files_without_writing_or_reading_a_column(spark, sample, folder):
    write_layer(sample, f"{folder}/t", single_file=True)
    write_layer(sample.limit(0), f"{folder}/none")
    before = files(folder)
    planned = publish.plan(spark, folder, {"t": "bucket/t", "none": "bucket/none"})
    line, none = planned.orderBy(F.desc("table")).collect()
    assert (line["table"], line["target"], line["n_rows"], line["n_files"]) == ("t", "bucket/t", 3, 1) and line["n_bytes"] > 0
    assert none["n_rows"] == 0
    plan = planned._jdf.queryExecution().executedPlan().toString()
    scans = [scan for scan in plan.split("FileScan")[1:] if scan.lstrip().startswith("parquet")]
    assert scans and all("ReadSchema: struct<>" in scan for scan in scans)
    assert files(folder) == before


# ------------------------------------------------------------------------------- warehouse
@pytest.fixture
def dataset(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    yield "marts"
    spark.sql("DROP DATABASE marts CASCADE")


def test_load_replaces_and_verifies(spark, sample, dataset):
    assert warehouse.load_tables(spark, {"t": sample}, {"t": SPEC}, dataset) == {"marts.t": 3}
    assert warehouse.load_tables(spark, {"t": sample.limit(1)}, {"t": SPEC}, dataset) == {"marts.t": 1}
    assert spark.table("marts.t").schema["amount"].dataType.simpleString() == "decimal(18,2)"


@pytest.mark.parametrize("name", ["my-marts", "", "a.b", "x;y"])
def test_bad_data_set_names_are_rejected_first(spark, sample, name):
    with pytest.raises(warehouse.LoadError, match="not valid"):
        warehouse.load_tables(spark, {"t": sample}, {"t": SPEC}, name)


def test_the_loaded_table_is_compared_whole(spark, sample, dataset):
    warehouse.load_tables(spark, {"t": sample}, {"t": SPEC}, dataset)
    check = lambda frame, spec=SPEC: rows(warehouse.loaded_problems(spark, {"t": frame}, {"t": spec}, dataset), "check", "key", "detail")
    assert check(sample) == []
    more = sample.unionByName(sample.filter("id = 1")).filter("id != 2")
    assert check(more) == [("warehouse rows", "1", "only published x1"), ("warehouse rows", "2", "only in the warehouse x1")]
    wider = TableSpec("t", SPEC.ddl + ", extra STRING")
    assert check(sample, wider) == [("warehouse schema", "extra", "column is missing")]


def test_load_stops_at_the_first_failure(spark, sample, dataset):
    other = sample.withColumnRenamed("note", "other")
    with pytest.raises(quality.QualityError, match="note: column is missing"):
        warehouse.load_tables(spark, {"t": other, "u": sample}, {"t": SPEC, "u": SPEC}, dataset)
    with pytest.raises(AnalysisException):
        spark.table("marts.u")


def test_decimals_may_not_change_type_in_silence(spark, sample, dataset):
    wide = sample.withColumn("amount", F.col("amount").cast("double"))
    with pytest.raises(quality.QualityError, match="type is double"):
        warehouse.load_tables(spark, {"t": wide}, {"t": SPEC}, dataset)


# ------------------------------------------------------------------------- sources, scratch
def test_source_reader_only_knows_listed_tables(spark, sample, folder):
    write_layer(sample, f"{folder}/t")
    source = ParquetSource(spark, folder, ("t",))
    assert source.table("t").count() == 3
    with pytest.raises(UnknownTable):
        source.table("passwords")


def test_row_counts_compare_only_common_tables(spark, sample):
    lake = reconcile.row_counts({"a": sample, "b": sample, "only_lake": sample})
    source = reconcile.row_counts({"a": sample, "b": sample.limit(2)})
    assert rows(reconcile.count_problems(lake, source)) == [("row count", "b", "rows", "lake 3, source 2")]


def test_scratch_folders_follow_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(f"{shared}/x-")


def test_published_files_are_hashed_by_many_tasks(spark, folder, monkeypatch):
    listed = publish.file_fingerprints

    def with_task(session, path, table):
        return listed(session, path, table).withColumn("md5", F.spark_partition_id().cast("string"))

    monkeypatch.setattr(publish, "file_fingerprints", with_task)
    bound = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(bound)
    spark.conf.set(bound, "1k")
    try:
        publish.publish({"t": spark.range(0, 1000, 1, 7)}, folder)
    finally:
        spark.conf.set(bound, before)
    lines = spark.read.schema(publish.FILE_SCHEMA).json(f"{folder}/_files").collect()
    assert len(lines) == 7 and len({r.md5 for r in lines}) == 7


def test_single_file_stages_rows_and_leaves_no_staging(spark, folder, monkeypatch):
    monkeypatch.setattr("ledgerlake.sinks.layers.scratch_dir", lambda _, name: f"{folder}/staged/{name}")
    assert write_layer(spark.range(0, 1000, 1, 7), f"{folder}/one", single_file=True) == 1000
    assert spark.read.parquet(f"{folder}/one").count() == 1000 and len(files(f"{folder}/one")) == 1
    assert os.path.exists(f"{folder}/staged") and not files(f"{folder}/staged")
