"""The batch runner on awkward batches and after failures (both modes)."""

import datetime as dt

import pytest

from tierflow.plans import batch, entities
from tierflow.sources import tables
from tests.conftest import rows, write_text

HDR = "locationid,city,state,zipcode,activeflag,createddate,modifieddate\n"
E = entities.LOCATION
REST = ("restaurantid,name,cuisinetype,pricing_for_2,restaurant_phone,operatinghours,locationid,"
        "activeflag,openstatus,locality,restaurant_address,latitude,longitude,createddate,modifieddate\n")


def day(n):
    return dt.datetime(2024, 1, n)


def line(i, city="Pune", zipcode="411001", flag="Yes"):
    return f"{i},{city},Maharashtra,{zipcode},{flag},2024-01-01 09:00:00,\\N\n"


def land(root, n, text):
    write_text(f"{root}/in/d{n}/f{n}.csv", text)
    return f"{root}/in/d{n}"


@pytest.mark.parametrize("mode", ["sound", "reference"])
def test_unchanged_batch_then_more(spark, tmp_dir, mode):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    batch.run_batch(wh, E, land(tmp_dir, 1, HDR + line(1) + line(2)), as_of=day(1), mode=mode)
    batch.run_batch(wh, E, land(tmp_dir, 2, HDR + line(1)), as_of=day(2), mode=mode)
    batch.run_batch(wh, E, land(tmp_dir, 3, HDR + line(3)), as_of=day(3), mode=mode)
    assert sorted(rows(wh.clean(E), "location_id")) == [(1,), (2,), (3,)]
    assert wh.dim(E, mode).count() == 3 and wh.dim(E, mode).filter("current_flag").count() == 3


def test_header_only_file_first_and_later(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    batch.run_batch(wh, E, land(tmp_dir, 1, HDR), as_of=day(1))
    assert wh.clean(E).count() == 0
    batch.run_batch(wh, E, land(tmp_dir, 2, HDR + line(1)), as_of=day(2))
    batch.run_batch(wh, E, land(tmp_dir, 3, HDR), as_of=day(3))
    assert rows(wh.clean(E), "location_id") == [(1,)] and wh.dim(E).count() == 1


def test_every_row_quarantined(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    bad = "9,Leh,Ladakh,194101,Yes,2024-01-01 09:00:00,\\N\n"
    batch.run_batch(wh, E, land(tmp_dir, 1, HDR + bad), as_of=day(1), checks="quarantine")
    batch.run_batch(wh, E, land(tmp_dir, 2, HDR + line(1)), as_of=day(2), checks="quarantine")
    assert rows(wh.clean(E), "location_id") == [(1,)]
    assert rows(spark.read.parquet(f"{tmp_dir}/wh/quarantine/location"), "location_id") == [(9,)]


def test_null_keys_are_not_lost(spark, tmp_dir):
    e = entities.RESTAURANT
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    rest = "{},{},Cafe,10,98,9-21,6,Active,Open,CP,Addr,1.5,77.1,\\N,\\N\n"
    batch.run_batch(wh, e, land(tmp_dir, 1, REST + rest.format("x", "A") + rest.format("y", "B") + rest.format("1", "C")), as_of=day(1))
    clean = wh.clean(e)
    assert sorted(rows(clean, "name")) == [("A",), ("B",), ("C",)]
    assert clean.select(e.surrogate).distinct().count() == 3
    # Without a key there is no entity to keep versions of.
    assert rows(wh.dim(e), "name") == [("C",)]


@pytest.mark.parametrize("mode", ["sound", "reference"])
@pytest.mark.parametrize("step", ["clean", "consumption"])
def test_failure_between_data_and_commit_leaves_no_trace(spark, tmp_dir, monkeypatch, mode, step):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    batch.run_batch(wh, E, land(tmp_dir, 1, HDR + line(1) + line(2)), as_of=day(1), mode=mode)
    real = tables._write_marker

    def fail(spark, folder, content):
        if f"/{step}/" in folder:
            raise OSError("lost")
        real(spark, folder, content)

    monkeypatch.setattr(tables, "_write_marker", fail)
    change = HDR + line(1, flag="No") + line(3)
    with pytest.raises(OSError):
        batch.run_batch(wh, E, land(tmp_dir, 2, change), as_of=day(2), mode=mode)
    monkeypatch.setattr(tables, "_write_marker", real)
    batch.run_batch(wh, E, None, as_of=day(2), mode=mode)
    batch.run_batch(wh, E, None, as_of=day(3), mode=mode)
    assert sorted(rows(wh.clean(E), "location_id", "active_flag")) == [(1, "No"), (2, "Yes"), (3, "Yes")]
    dim = wh.dim(E, mode)
    assert sorted(rows(dim.filter("current_flag"), "location_id", "active_flag")) == [(1, "No"), (2, "Yes"), (3, "Yes")]
    assert rows(dim.filter("not current_flag"), "location_id", "active_flag") == [(1, "Yes")]


def test_versions_applied_late_are_netted(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    for n, flag in ((1, "Yes"), (2, "No"), (3, "Yes")):
        batch.copy_into(wh, E, land(tmp_dir, n, HDR + line(1, flag=flag) + line(10 + n, zipcode=str(411010 + n))), as_of=day(n))
        batch.run_clean(wh, E, as_of=day(n))
    batch.run_dim(wh, E, as_of=day(4))
    dim = wh.dim(E)
    assert sorted(rows(dim, "location_id", "active_flag")) == [(1, "Yes"), (11, "Yes"), (12, "Yes"), (13, "Yes")]
    assert dim.select(E.dim_hash).distinct().count() == dim.count()


def test_rows_that_cannot_be_parsed_go_to_quarantine(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    got = batch.copy_into(wh, E, land(tmp_dir, 1, HDR + line(1) + "7,broken\n"), as_of=day(1), on_error="continue")
    assert got.rows == 1 and rows(wh.stage(E), "locationid") == [("1",)]
    bad = spark.read.parquet(f"{tmp_dir}/wh/quarantine/location_load")
    assert [r._corrupt_record.strip() for r in bad.collect()] == ["7,broken"]


def test_many_files_load_in_bounded_batches(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    for n in range(5):
        write_text(f"{tmp_dir}/in/f{n}.csv", HDR + line(n))
    got = batch.copy_into(wh, E, f"{tmp_dir}/in", as_of=day(1), max_files=2)
    assert (got.files, got.rows, got.batch_id) == (5, 5, 3)
    batch.run_clean(wh, E, as_of=day(1))
    assert wh.clean(E).count() == 5


def test_insert_stamp_is_the_time_of_the_merge(spark, tmp_dir):
    e = entities.RESTAURANT
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    rest = "1,{},Cafe,10,98,9-21,6,Active,Open,CP,Addr,1.5,77.1,\\N,\\N\n"
    batch.copy_into(wh, e, land(tmp_dir, 1, REST + rest.format("A")), as_of=day(1))
    batch.run_clean(wh, e, as_of=day(5))
    batch.copy_into(wh, e, land(tmp_dir, 2, REST + rest.format("B")), as_of=day(6))
    batch.run_clean(wh, e, as_of=day(7))
    assert rows(wh.clean(e), "name", "_copy_data_ts") == [("B", day(5))]


def test_header_of_another_order_fails_by_name(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    write_text(f"{tmp_dir}/in/a.csv", HDR + line(1))
    write_text(f"{tmp_dir}/in/b.csv", HDR.replace("city,state", "state,city") + line(2))
    with pytest.raises(Exception):
        batch.copy_into(wh, E, f"{tmp_dir}/in", as_of=day(1), bind_by="name")
