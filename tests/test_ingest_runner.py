import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierflow.plans import batch, entities
from tierflow.sources import ingest
from tests.conftest import rows, write_text

LOCATION_DAY1 = """locationid,city,state,zipcode,activeflag,createddate,modifieddate
1,Delhi,Delhi,110001,Yes,2024-01-01 09:00:00,\\N
2,Mumbai,Maharashtra,400001,Yes,2024-01-01 09:00:00,2024-01-02 10:00:00
3,Bangalore,Karnataka,560001,Yes,2024-01-01 09:00:00,\\N
4,"Jaipur",Rajasthan,302001,No,2024-01-01 09:00:00,\\N
5,Smalltown,Kerala,680001,Yes,2024-01-01 09:00:00,\\N
6,New Delhi,New Delhi,110002,Yes,2024-01-01 09:00:00,\\N
"""

LOCATION_DAY2 = """locationid,city,state,zipcode,activeflag,createddate,modifieddate
2,Mumbai,Maharashtra,400002,Yes,2024-01-01 09:00:00,2024-01-02 10:00:00
4,Jaipur,Rajasthan,302001,Yes,2024-01-01 09:00:00,\\N
1,Delhi,Delhi,110001,Yes,2024-01-01 09:00:00,2024-01-03 10:00:00
5,Smalltown,Kerala,680001,Yes,2024-01-01 09:00:00,\\N
"""


def test_csv_format_nulls_quotes_and_positional(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/a/f.csv",
                   'id,name,State,Pincode,note\n1,"Doe, J",Delhi,110001,"say ""hi"""\n2,X,,\\N,""\n')
    df = ingest.read_staged(spark, p, ["id", "name", "State", "Pincode", "note"],
                            target_cols=["id", "name", "pincode", "state", "note"])
    got = {r.id: r for r in df.collect()}
    assert got["1"].name == "Doe, J" and got["1"].note == 'say "hi"'
    assert got["1"].pincode == "Delhi" and got["1"].state == "110001"       # bound by position
    assert got["2"].pincode is None and got["2"].state is None and got["2"].note == ""
    assert got["1"]._stg_file_name.endswith("/a/f.csv") and got["1"]._stg_file_md5


def test_multiline_field_needs_option(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/m/f.csv", 'id,pref\n1,"line one\nline two"\n')
    df = ingest.read_staged(spark, p, ["id", "pref"], multi_line=True)
    assert rows(df, "pref") == [("line one\nline two",)]


def test_ragged_rows_abort_or_pad(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/r/f.csv", "a,b,c\n1,2,3\n4,5\n")
    with pytest.raises(Exception):
        ingest.read_staged(spark, p, ["a", "b", "c"]).collect()
    padded = ingest.read_staged(spark, p, ["a", "b", "c"], ragged="pad")
    assert rows(padded, "a", "c") == [("1", "3"), ("4", None)]


def test_copy_into_skips_loaded_files_and_keeps_history(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    e = entities.LOCATION
    write_text(f"{tmp_dir}/in/initial/location-5rows.csv", LOCATION_DAY1)
    first = batch.copy_into(wh, e, f"{tmp_dir}/in", as_of=dt.datetime(2024, 1, 1, 12))
    again = batch.copy_into(wh, e, f"{tmp_dir}/in", as_of=dt.datetime(2024, 1, 1, 12, 5))
    assert (first.files, first.rows) == (1, 6) and again.rows == 0 and again.batch_id is None
    write_text(f"{tmp_dir}/in/delta/day-02+update.csv", LOCATION_DAY2)
    delta = batch.copy_into(wh, e, f"{tmp_dir}/in", as_of=dt.datetime(2024, 1, 2, 12))
    assert (delta.files, delta.rows, delta.batch_id) == (1, 4, 2)
    hist = wh.ledger.copy_history("location", now=dt.datetime(2024, 1, 2, 12, 30))
    assert rows(hist, "rows_loaded") == [(4,)]
    assert wh.stage(e).count() == 10


def test_location_pipeline_both_modes(spark, tmp_dir):
    e = entities.LOCATION
    for mode in ("reference", "sound"):
        wh = batch.Warehouse(spark, f"{tmp_dir}/wh-{mode}")
        write_text(f"{tmp_dir}/{mode}/d1/location.csv", LOCATION_DAY1)
        batch.run_batch(wh, e, f"{tmp_dir}/{mode}/d1", as_of=dt.datetime(2024, 1, 1), mode=mode)
        write_text(f"{tmp_dir}/{mode}/d2/location.csv", LOCATION_DAY2)
        batch.run_batch(wh, e, f"{tmp_dir}/{mode}/d2", as_of=dt.datetime(2024, 1, 2), mode=mode)
        clean = {r.location_id: r for r in wh.clean(e).collect()}
        assert len(clean) == 6 and len({r.restaurant_location_sk for r in clean.values()}) == 6
        assert clean[2].zip_code == "400002" and clean[4].active_flag == "Yes"
        # created_ts is not in the update list
        assert clean[2].created_ts == dt.datetime(2024, 1, 1, 9, 0)
        dim = wh.dim(e, mode)
        cur = {r.location_id for r in dim.filter("current_flag").collect()}
        if mode == "reference":
            # zip change without flag change: closed, successor never inserted
            assert 2 not in cur and 4 in cur
            # NULL -> value of modified_ts is missed by the reference predicate
            assert clean[1].modified_ts is None
        else:
            assert cur == {1, 2, 3, 4, 5, 6}
            assert clean[1].modified_ts is not None


def test_missing_state_code_aborts_load(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    write_text(f"{tmp_dir}/bad/f.csv", "locationid,city,state,zipcode,activeflag,createddate,modifieddate\n"
                                       "9,Leh,Ladakh,194101,Yes,2024-01-01 09:00:00,\\N\n")
    with pytest.raises(Exception):
        batch.run_batch(wh, entities.LOCATION, f"{tmp_dir}/bad", as_of=dt.datetime(2024, 1, 1))
    assert wh.clean(entities.LOCATION) is None


def test_quarantine_keeps_good_rows(spark, tmp_dir):
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    write_text(f"{tmp_dir}/q/f.csv", "locationid,city,state,zipcode,activeflag,createddate,modifieddate\n"
                                     "9,Leh,Ladakh,194101,Yes,2024-01-01 09:00:00,\\N\n"
                                     "10,Pune,Maharashtra,411001,Yes,2024-01-01 09:00:00,\\N\n")
    batch.run_batch(wh, entities.LOCATION, f"{tmp_dir}/q", as_of=dt.datetime(2024, 1, 1), checks="quarantine")
    assert rows(wh.clean(entities.LOCATION), "location_id") == [(10,)]
    bad = spark.read.parquet(f"{tmp_dir}/wh/quarantine/location")
    assert rows(bad, "location_id") == [(9,)]


def test_privacy_tags_survive_parquet_and_mask(spark, tmp_dir):
    from tierflow.functions import privacy
    df = spark.createDataFrame([("1", "98765", None)], "id string, mobile string, email string")
    tagged = privacy.tag(df, {"mobile": "PII", "email": "EMAIL"})
    tagged.write.parquet(f"{tmp_dir}/t")
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert privacy.tags_of(back) == {"mobile": "PII", "email": "EMAIL"}
    m = privacy.mask(back).first()
    assert (m.id, m.mobile, m.email) == ("1", "** PII **", "** EAMIL **")
    with pytest.raises(ValueError):
        privacy.tag(df, {"id": "SECRET"})
