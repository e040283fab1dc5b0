"""Drops, zones, history and the publish protocol."""

from datetime import date

import drops
import pytest
from pyspark.sql import functions as F

from ordermill.errors import LoadRefused, PublishRefused, SourceMalformed, SourceMissing, SourceUnsteady
from ordermill.model import CONFORMED, SOURCE
from ordermill.sources import ingest, layout, publish
from ordermill.sources.lake import Lake

DAY = date(2026, 9, 1)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_layout():
    assert layout.partition("raw", "orders", DAY) == "raw/orders/year=2026/month=09/day=01"
    assert layout.drop("orders", "historical", DAY) == "orders/orders_historical.csv"
    assert layout.drop("orders", "incremental", DAY) == "orders/orders_2026-09-01.csv"
    assert layout.staging("processed", "orders", "a:b+c") == "_tmp/a_b_c/processed/orders"
    assert layout.quality_report("orders", DAY).endswith("day=01/orders.json")
    with pytest.raises(ValueError):
        layout.drop("orders", "weekly", DAY)
    with pytest.raises(ValueError):
        layout.partition("attic", "orders", DAY)


def run(lake, root, dataset="customers"):
    return ingest.ingest(lake, str(root), dataset, "incremental", DAY, "run:1")


def test_ingest_keeps_text_and_adds_lineage(lake, tmp_path):
    path = drops.write(tmp_path, "customers", "2026-09-01", [])
    path.write_bytes(
        "﻿customer_id,customer_name,email,city,signup_date\n"
        'C1,"Rao, ""K""",k@x.y, Pune ,2026-01-01\n'
        "\n"
        'C2,"two\nlines",,Delhi,bad\n'.encode()
    )
    result = run(lake, tmp_path)
    assert (result["status"], result["records_read"], result["records_written"]) == ("SUCCESS", 2, 2)
    assert result["source_file"] == "customers/customers_2026-09-01.csv"
    raw = lake.read_partition("raw", "customers", DAY, ingest.raw_schema("customers"))
    rows = raw.orderBy("_source_row_number").collect()
    assert [r["customer_name"] for r in rows] == ['Rao, "K"', "two\nlines"]
    assert rows[0]["city"] == " Pune " and rows[1]["signup_date"] == "bad"
    assert [r["_source_row_number"] for r in rows] == [1, 2]
    assert rows[0]["_ingestion_date"] == DAY and rows[0]["_run_id"] == "run:1"
    assert rows[0]["_ingestion_timestamp"] is not None


def test_header_only_drop_is_no_data(lake, tmp_path):
    drops.write(tmp_path, "customers", "2026-09-01", [])
    assert run(lake, tmp_path)["status"] == "NO_DATA"


@pytest.mark.parametrize(
    ("header", "detail"),
    [
        (["customer_id", "customer_name", "email", "city"], "missing=\\['signup_date'\\]"),
        (["customer_id", "customer_name", "email", "city", "signup_date", "x"], "unexpected=\\['x'\\]"),
        (["customer_name", "customer_id", "email", "city", "signup_date"], "order=differs"),
        (["Customer_id", "customer_name", "email", "city", "signup_date"], "Customer_id"),
    ],
)
def test_header_must_match(lake, tmp_path, header, detail):
    drops.write(tmp_path, "customers", "2026-09-01", [], header)
    with pytest.raises(SourceMalformed, match=detail):
        run(lake, tmp_path)


@pytest.mark.parametrize("row", ["C2,x,y,z", "C2,x,y,z,2026-01-01,more"])
def test_wrong_field_count_names_the_row(lake, tmp_path, row):
    path = drops.write(tmp_path, "customers", "2026-09-01", [("C1", "a", "b", "c", "2026-01-01")])
    path.write_text(path.read_text() + row + "\n")
    with pytest.raises(SourceMalformed, match="row_number=2"):
        run(lake, tmp_path)
    assert not lake.exists(layout.partition("raw", "customers", DAY))


def test_unusable_drops(lake, tmp_path):
    with pytest.raises(SourceMissing):
        run(lake, tmp_path)
    path = drops.write(tmp_path, "customers", "2026-09-01", [])
    path.write_bytes(path.read_bytes() + b"C1,\xff\xfe,x,y,2026-01-01\n")
    with pytest.raises(SourceMalformed, match="UTF-8"):
        run(lake, tmp_path)
    path.write_bytes(b"")
    with pytest.raises(SourceMalformed, match="empty"):
        run(lake, tmp_path)


def test_drop_of_several_files_is_numbered_through(lake, tmp_path):
    folder = tmp_path / "customers" / "customers_2026-09-01.csv"
    folder.mkdir(parents=True)
    header = ",".join(SOURCE["customers"].fieldNames())
    for name, keys in (("a.csv", "12"), ("b.csv", "345")):
        lines = [f"C{k},n,e,c,2026-01-01" for k in keys]
        (folder / name).write_text("\n".join([header, *lines]) + "\n")
    assert run(lake, tmp_path)["records_written"] == 5
    raw = lake.read_partition("raw", "customers", DAY, ingest.raw_schema("customers"))
    assert {r["_source_row_number"]: r["customer_id"] for r in raw.collect()} == {
        n: f"C{n}" for n in range(1, 6)
    }


@pytest.mark.parametrize(
    ("second", "detail"),
    [
        ("customer_id,customer_name,email,City,signup_date", "unexpected=\\['City'\\]"),
        ("customer_name,customer_id,email,city,signup_date", "order=differs"),
        ("C9,n,e,c,2026-01-01", "missing="),
        ("", "file=b.csv"),
        ("customer_id,customer_name,email,city,signup_date,", "file=b.csv"),
    ],
)
def test_every_file_of_a_drop_needs_its_header(lake, tmp_path, second, detail):
    folder = tmp_path / "customers" / "customers_2026-09-01.csv"
    folder.mkdir(parents=True)
    header = ",".join(SOURCE["customers"].fieldNames())
    (folder / "a.csv").write_text(f"{header}\nC1,n,e,c,2026-01-01\n")
    (folder / "b.csv").write_text(f"{second}\nC2,n,e,c,2026-01-01\n")
    with pytest.raises(SourceMalformed, match=detail) as refused:
        run(lake, tmp_path)
    assert refused.value.context["file"] == "b.csv"
    assert not lake.exists(layout.partition("raw", "customers", DAY))


def test_file_without_content_is_refused(lake, tmp_path):
    folder = tmp_path / "customers" / "customers_2026-09-01.csv"
    folder.mkdir(parents=True)
    header = ",".join(SOURCE["customers"].fieldNames())
    (folder / "a.csv").write_text(f"{header}\nC1,n,e,c,2026-01-01\n")
    (folder / "b.csv").write_text("")
    with pytest.raises(SourceMalformed, match="file=b.csv"):
        run(lake, tmp_path)


def test_only_files_with_open_quotes_are_read_whole(lake, tmp_path):
    folder = tmp_path / "customers" / "customers_2026-09-01.csv"
    folder.mkdir(parents=True)
    header = ",".join(f'"{name}"' for name in SOURCE["customers"].fieldNames())
    (folder / "a.csv").write_text(f"{header}\nC1,n,e,c,2026-01-01\nC2,n,e,c,2026-01-01\n")
    (folder / "b.csv").write_text(f'{header}\nC3,"two\nlines",e,c,2026-01-01\nC4,n,e,c,2026-01-01\n')
    (folder / "c.csv").write_text(f"{header}\nC5,n,e,c,2026-01-01\n")
    drops_of = Lake(lake.spark, str(tmp_path))
    whole, spanning = ingest.inspect_drop(drops_of, layout.drop("customers", "incremental", DAY), "customers")
    assert [p.rpartition("/")[2] for p in whole] == ["a.csv", "c.csv"]
    assert [p.rpartition("/")[2] for p in spanning] == ["b.csv"]
    result = run(lake, tmp_path)
    assert (result["records_read"], result["records_written"]) == (5, 5)
    raw = lake.read_partition("raw", "customers", DAY, ingest.raw_schema("customers"))
    assert {r["_source_row_number"]: r["customer_id"] for r in raw.collect()} == {n: f"C{n}" for n in range(1, 6)}


def test_counts_that_differ_stop_the_write(lake, tmp_path, monkeypatch):
    drops.write(tmp_path, "customers", "2026-09-01", [("C1", "a", "b", "c", "2026-01-01")])
    counted = ingest.block_starts

    def another_row(rows):
        return counted(rows).withColumn("_rows", F.col("_rows") + 1)

    monkeypatch.setattr(ingest, "block_starts", another_row)
    with pytest.raises(SourceUnsteady, match="counted=2, written=1"):
        run(lake, tmp_path)
    assert not lake.exists(layout.partition("raw", "customers", DAY))


def test_raw_csv_reader(spark, tmp_path):
    names = ingest.raw_schema("customers").fieldNames()
    path = tmp_path / "customers.csv"
    row = "C1,n,e,c,2026-01-01,2026-09-01 06:00:00,2026-09-01,f.csv,7,r1"
    path.write_text(",".join(names) + "\n" + row + "\n")
    got = ingest.read_raw_csv(spark, str(path), "customers").first()
    assert (got["_source_row_number"], got["_ingestion_date"]) == (7, DAY)
    path.write_text(",".join(reversed(names)) + "\n" + row + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.read_raw_csv(spark, str(path), "customers").collect()


def customers(spark, rows, day=DAY):
    values = [(k, "n", None, city, None, day, "r") for k, city in rows]
    return spark.createDataFrame(values, CONFORMED["customers"])


def stage_and_publish(lake, df, day, run_id):
    publish.stage(lake, "customers", df, day, run_id)
    return publish.publish(lake, day, run_id, ("customers",))[0]


def test_replacing_a_partition_leaves_others(lake, spark):
    for day in (DAY, date(2026, 9, 2)):
        lake.write_partition(customers(spark, [("C1", "Pune")]), "validated", "customers", day, "r")
    lake.write_partition(customers(spark, []), "validated", "customers", DAY, "r2")
    read = lambda day: lake.read_partition("validated", "customers", day, CONFORMED["customers"])
    assert (read(DAY).count(), read(date(2026, 9, 2)).count()) == (0, 1)

    def fail(uri):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        lake.replace_partition("validated", "customers", date(2026, 9, 2), "r3", fail)
    assert read(date(2026, 9, 2)).count() == 1


def test_crash_while_replacing_loses_nothing(lake, spark, monkeypatch):
    lake.write_partition(customers(spark, [("C1", "old")]), "processed", "customers", DAY, "r1")
    move, moves = Lake.move, []

    def stop_at_second(self, source, target):
        moves.append(source)
        if len(moves) == 2:
            raise RuntimeError("lost")
        move(self, source, target)

    monkeypatch.setattr(Lake, "move", stop_at_second)
    with pytest.raises(RuntimeError):
        lake.write_partition(customers(spark, [("C1", "new")]), "processed", "customers", DAY, "r2")
    monkeypatch.setattr(Lake, "move", move)
    assert not lake.exists(layout.partition("processed", "customers", DAY))
    later = date(2026, 9, 9)
    assert [r["city"] for r in lake.history("customers", later).collect()] == ["old"]
    read = lambda: lake.read_partition("processed", "customers", DAY, CONFORMED["customers"])
    assert read().first()["city"] == "old"
    lake.write_partition(customers(spark, [("C1", "new")]), "processed", "customers", DAY, "r3")
    assert [r["city"] for r in read().collect()] == ["new"]
    with pytest.raises(OSError):  # never into a folder that exists
        lake.move("processed/customers", layout.partition("processed", "customers", DAY))


def test_history_is_strictly_before_and_pruned(lake, spark):
    assert lake.history("customers", DAY) is None
    assert lake.history_keys("customers", DAY) is None
    for number, day in enumerate((date(2025, 12, 31), date(2026, 8, 31), DAY)):
        stage_and_publish(lake, customers(spark, [(f"C{number}", "x")], day), day, f"r{number}")
    history = lake.history("customers", DAY)
    assert sorted(r["customer_id"] for r in history.collect()) == ["C0", "C1"]
    assert history.columns == CONFORMED["customers"].fieldNames()
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(make_date" in plan or "make_date" in plan.split("PartitionFilters")[1][:200]
    assert sorted(r[0] for r in lake.history_keys("customers", DAY).collect()) == ["C0", "C1"]


def test_publish_writes_manifest_and_retry_does_nothing(lake, spark):
    manifest = stage_and_publish(lake, customers(spark, [("C1", "a"), ("C2", "b")]), DAY, "r1")
    assert (manifest["row_count"], manifest["run_id"]) == (2, "r1")
    assert manifest["source_partitions"] == [layout.partition("raw", "customers", DAY)]
    assert manifest["schema"][0] == {"name": "customer_id", "type": "string"}
    target = layout.partition("processed", "customers", DAY)
    files = lake.spark.read.json(lake.uri(f"{target}/{publish.FILES}"))
    assert files.agg(F.sum("row_count")).first()[0] == 2
    assert publish.publish(lake, DAY, "r1", ("customers",)) == [manifest]
    assert not lake.exists(layout.staging("processed", "customers", "r1"))


def test_nothing_is_published_unless_everything_verifies(lake, spark):
    stage_and_publish(lake, customers(spark, [("C1", "old")]), DAY, "r1")
    publish.stage(lake, "customers", customers(spark, [("C1", "new")]), DAY, "r2")
    with pytest.raises(PublishRefused, match="restaurants"):
        publish.publish(lake, DAY, "r2", ("customers", "restaurants"))
    assert publish.read_manifest(lake, "customers", DAY)["run_id"] == "r1"
    city = lake.read_partition("processed", "customers", DAY, CONFORMED["customers"]).first()["city"]
    assert city == "old"


def test_staged_output_must_match(lake, spark):
    folder = layout.staging("processed", "customers", "r1")
    publish.stage(lake, "customers", customers(spark, [("C1", "a")]), DAY, "r1")
    customers(spark, [("C2", "b")]).write.mode("append").parquet(lake.uri(folder))
    with pytest.raises(PublishRefused, match="row count"):
        publish.verify_staged(lake, "customers", DAY, "r1")
    publish.stage(lake, "customers", customers(spark, [("C1", "a")]).drop("city"), DAY, "r1")
    with pytest.raises(PublishRefused, match="city: expected string"):
        publish.verify_staged(lake, "customers", DAY, "r1")
    wrong = customers(spark, [("C1", "a")]).select(*reversed(CONFORMED["customers"].fieldNames()))
    publish.stage(lake, "customers", wrong, DAY, "r1")
    with pytest.raises(PublishRefused, match="order differs"):
        publish.verify_staged(lake, "customers", DAY, "r1")


def test_interrupted_publish_is_finished_by_a_retry(lake, spark):
    publish.stage(lake, "customers", customers(spark, [("C1", "a")]), DAY, "r1")
    target = layout.partition("processed", "customers", DAY)
    lake.move(layout.staging("processed", "customers", "r1"), target)  # stopped before the manifest
    assert publish.read_manifest(lake, "customers", DAY) is None
    assert publish.publish(lake, DAY, "r1", ("customers",))[0]["row_count"] == 1
    assert not lake.exists(f"{target}/{publish.STAGED}")


def test_empty_dataset_can_be_staged(lake, spark):
    assert stage_and_publish(lake, customers(spark, []), DAY, "r1")["row_count"] == 0




def test_second_writer_of_a_version_is_refused(spark, tmp_path):
    from ordermill.model import STAR
    from ordermill.sources.warehouse import Warehouse

    first, second = (Warehouse(spark, f"file:{tmp_path}/star") for _ in range(2))
    rows = spark.createDataFrame([], STAR["dim_date"])
    seen = first.version("dim_date"), second.version("dim_date")
    folder = first.next_folder("dim_date")
    rows.write.parquet(first.files.uri(f"dim_date/{folder}"))
    assert second.next_folder("dim_date") != folder
    first.commit("dim_date", {"all": folder}, 0, after=seen[0])
    with pytest.raises(LoadRefused, match="another load"):
        second.replace("dim_date", rows, seen[1])
    assert second.read("dim_date").count() == 0
    assert first.record("dim_date")["parts"] == {"all": folder}


def test_partitions_are_stored_as_zstd(spark, tmp_path):
    """Whatever the session's own codec is; the rows are those written."""
    from ordermill.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    rows = spark.range(10).selectExpr("CAST(id AS STRING) AS order_id")
    path = lake.write_partition(rows, "validated", "orders", date(2026, 9, 3), "r1")
    files = [file.name for file in (tmp_path / path).iterdir() if file.name.endswith(".parquet")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    assert sorted(lake.read(path, rows.schema).collect()) == sorted(rows.collect())
