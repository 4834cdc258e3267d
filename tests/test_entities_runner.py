"""Customer, address, restaurant and menu through copy -> clean -> dimension (FIXTURES.md edge rows)."""

import datetime as dt
from decimal import Decimal

import pytest

from tierflow.functions import privacy
from tierflow.operators.merge import DuplicateKeyError
from tierflow.plans import batch, entities
from tests.conftest import rows, write_text

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)

CUSTOMER_DAY1 = (
    "customerid,name,mobile,email,loginbyusing,gender,dob,anniversary,preferences,createddate,modifieddate\n"
    'c1,Asha,9876543210,asha@x.in,Google,Female,1990-12-31,\\N,"veg, ""jain""",2024-01-01T09:00:00.123456,\\N\n'
    'c2,Ravi,\\N,,App,Male,31-12-1990,2015-02-14,"line one\nline two",2024-01-01T09:00:00.5,\\N\n'
    'c3,Meera,9000000000,"",Web,\\N,1985-05-05,\\N,\\N,2024-01-01T09:00:00,\\N\n'
)
CUSTOMER_DAY2 = (
    "customerid,name,mobile,email,loginbyusing,gender,dob,anniversary,preferences,createddate,modifieddate\n"
    "c1,Asha K,9876543210,asha@x.in,Google,Female,1990-12-31,\\N,veg,2024-01-01T09:00:00.123456,2024-01-02T09:00:00.000001\n"
    "c4,Neel,\\N,\\N,App,Male,\\N,\\N,\\N,2024-01-02T09:00:00.000000,\\N\n"
)


def test_customer_entity(spark, tmp_dir):
    e = entities.CUSTOMER
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    write_text(f"{tmp_dir}/d1/customers.csv", CUSTOMER_DAY1)
    batch.run_batch(wh, e, f"{tmp_dir}/d1", as_of=D1)
    write_text(f"{tmp_dir}/d2/day-02-insert-update.csv", CUSTOMER_DAY2)
    batch.run_batch(wh, e, f"{tmp_dir}/d2", as_of=D2)
    clean = wh.clean(e)
    got = {r.customer_id: r for r in clean.collect()}
    assert got["c1"].name == "Asha K" and got["c1"].preferences == "veg"
    assert got["c2"].dob is None and got["c2"].preferences == "line one\nline two"
    assert got["c2"].email is None and got["c3"].email == ""        # unquoted empty vs ""
    assert got["c2"].created_dt == dt.datetime(2024, 1, 1, 9, 0, 0, 500000)   # FF6: up to 6 digits
    assert got["c1"].created_dt == dt.datetime(2024, 1, 1, 9, 0, 0, 123456)
    assert privacy.tags_of(clean)["email"] == "EMAIL"
    masked = {r.customer_id: r for r in privacy.mask(clean).collect()}
    assert masked["c1"].mobile == "** PII **" and masked["c1"].email == "** EAMIL **"
    dim = wh.dim(e)
    assert dim.filter("is_current").count() == 4 and dim.count() == 5
    assert rows(dim.filter("customer_id = 'c1' AND NOT is_current"), "name") == [("Asha",)]


ADDRESS_HDR = ("addressid,customerid,flatno,houseno,floor,building,landmark,locality,city,State,Pincode,"
               "coordinates,primaryflag,addresstype,createddate,modifieddate\n")


def test_address_positional_binding_and_partial_update(spark, tmp_dir):
    e = entities.CUSTOMER_ADDRESS
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    write_text(f"{tmp_dir}/initial/customer_address/a.csv", ADDRESS_HDR +
               "1,10,A1,12,2,Tower,Park,Saket,Delhi,Delhi,110017,\"28.5,77.2\",Y,Home,"
               "2024-01-01T09:00:00,2024-01-01T09:00:00.5\n")
    batch.run_batch(wh, e, f"{tmp_dir}/initial", as_of=D1)
    r = wh.clean(e).first()
    assert (r.pincode, r.state) == ("Delhi", "110017")            # file State -> pincode
    assert r.modified_date is None and r.created_date is not None
    write_text(f"{tmp_dir}/delta/customer_address/b.csv", ADDRESS_HDR +
               "1,99,A2,12,2,Tower,Park,Saket,Delhi,Delhi,110017,\"28.5,77.2\",Y,Home,"
               "2024-01-01T09:00:00,2024-01-02T09:00:00\n")
    batch.run_batch(wh, e, f"{tmp_dir}/delta", as_of=D2)
    r = wh.clean(e).first()
    assert r.flat_no == "A2" and r.customer_id_fk == 10           # fk not in the update list
    bad = f"{tmp_dir}/bad/c.csv"
    write_text(bad, ADDRESS_HDR + "x,10,A,1,1,B,L,Lo,C,S,P,Co,Y,Home,\\N,\\N\n")
    with pytest.raises(Exception):
        batch.run_batch(wh, e, f"{tmp_dir}/bad", as_of=D2)


REST_HDR = ("restaurantid,name,cuisinetype,pricing_for_2,restaurant_phone,operatinghours,locationid,"
            "activeflag,openstatus,locality,restaurant_address,latitude,longitude,createddate,modifieddate\n")


def test_restaurant_try_casts_and_copy_ts(spark, tmp_dir):
    e = entities.RESTAURANT
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    write_text(f"{tmp_dir}/d1/restaurant-delhi+NCR.csv", REST_HDR +
               '1,Dhaba,North Indian,12.345,9811111111,10-22,6,Active,Open,CP,"Block A, CP",28.6315,77.2167,'
               "2024-01-01 09:00:00.123456789,\\N\n"
               "x,NoKey,Cafe,abc,9822222222,9-21,6,Active,Open,CP,Addr,1234.5,77.1,\\N,\\N\n")
    batch.run_batch(wh, e, f"{tmp_dir}/d1", as_of=D1)
    got = {r.name: r for r in wh.clean(e).collect()}
    assert got["Dhaba"].pricing_for_two == Decimal("12.35")
    assert got["Dhaba"].created_dt is not None and got["Dhaba"].created_dt.microsecond == 123456
    assert got["NoKey"].restaurant_id is None and got["NoKey"].pricing_for_two is None
    assert got["NoKey"].latitude is None
    first_copy_ts = got["Dhaba"]._copy_data_ts
    write_text(f"{tmp_dir}/d2/day-01-insert-restaurant-delhi+NCR.csv", REST_HDR +
               '1,Dhaba,North Indian,15,9811111111,10-23,6,Active,Open,CP,"Block A, CP",28.6315,77.2167,'
               "2024-01-01 09:00:00.123456789,2024-01-02 09:00:00.0\n"
               "x,NoKey,Cafe,abc,9822222222,9-21,6,Active,Open,CP,Addr,1234.5,77.1,\\N,\\N\n")
    batch.run_batch(wh, e, f"{tmp_dir}/d2", as_of=D2)
    clean = wh.clean(e)
    assert clean.filter("name = 'NoKey'").count() == 2             # NULL key never matches
    d = clean.filter("restaurant_id = 1").first()
    assert d.pricing_for_two == Decimal("15.00") and d._copy_data_ts == first_copy_ts
    assert privacy.mask(clean).first().restaurant_phone == "** Phone **"


MENU_HDR = "menuid,restaurantid,itemname,description,price,category,availability,itemtype,createddate,modifieddate\n"


def test_menu_whole_stage_reread(spark, tmp_dir):
    e = entities.MENU
    d1 = MENU_HDR + "7.5,1,  Paneer Tikka ,Starter,250,Veg,TRUE,Veg,2024-01-01 10:00:00,\\N\n" \
                    "9,1,Dal,Lentils,120,Main,False,Veg,2024-01-01 10:00:00,\\N\n"
    d2 = MENU_HDR + "8,1,Paneer Tikka,Starter,275,Veg,yes,Veg,2024-01-01 10:00:00,2024-01-02 10:00:00\n"
    for mode in ("sound", "reference"):
        wh = batch.Warehouse(spark, f"{tmp_dir}/{mode}")
        write_text(f"{tmp_dir}/{mode}-in/d1/menu.csv", d1)
        batch.run_batch(wh, e, f"{tmp_dir}/{mode}-in/d1", as_of=D1, mode=mode)
        got = {r.menu_id: r for r in wh.clean(e).collect()}
        assert got[8].item_name == "Paneer Tikka" and got[8].availability is True
        assert got[9].availability is False and got[8]._copy_data_ts == D1
        write_text(f"{tmp_dir}/{mode}-in/d2/menu.csv", d2)
        if mode == "reference":
            # the whole stage is re-read: key 8 appears twice and matches -> the merge fails
            with pytest.raises(DuplicateKeyError):
                batch.run_batch(wh, e, f"{tmp_dir}/{mode}-in/d2", as_of=D2, mode=mode)
        else:
            batch.run_batch(wh, e, f"{tmp_dir}/{mode}-in/d2", as_of=D2, mode=mode)
            got = {r.menu_id: r for r in wh.clean(e).collect()}
            assert got[8].price == Decimal("275.00") and got[8].availability is None
            assert got[8]._copy_data_ts == D2 and len(got) == 2
            assert wh.dim(e).filter("is_current").count() == 2
