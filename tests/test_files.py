"""Multi-line CSV in byte ranges; content keys; reloads."""

import csv
import os
import random

import pytest

from tierflow.plans import batch, entities
from tierflow.sources import ingest, multiline
from tests.conftest import write_text

RANGES = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"}
OPTIONS = dict(ingest.CSV_OPTIONS, mode="FAILFAST")


@pytest.fixture()
def small_ranges(spark):
    kept = {k: spark.conf.get(k) for k in RANGES}
    for k, v in RANGES.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def random_file(path, line_end, seed):
    rnd = random.Random(seed)

    def cell():
        return "".join(rnd.choice(["a", '"', ",", line_end, line_end, "é", " x ", "\\N", ""]) for _ in range(rnd.randint(0, 6)))

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=line_end)
        out.writerow(["h1", f"h{line_end}2", "h3"])
        for i in range(400):
            out.writerow([f"{seed}-{i}", cell(), cell()])
        out.writerow([f"{seed}-long", line_end.join("x" * 50 for _ in range(200)), ""])  # over several ranges
        f.write(f'{line_end}{line_end}"{seed}-end","a{line_end}b",c')


def read(df):
    return sorted(((r.a, r.b, r.c) for r in df.collect()), key=repr)


def test_equals_multiline_reader(spark, tmp_dir, small_ranges):
    for i, line_end in enumerate(["\n", "\r\n", "\n"]):
        random_file(f"{tmp_dir}/f{i}.csv", line_end, i)
    scan = multiline.lines(spark, [tmp_dir])
    assert scan.select("__file", "__block").distinct().count() > 10
    got = multiline.read_records(spark, [tmp_dir], ingest.text_schema("abc"), OPTIONS)
    want = ingest.csv_reader(spark, list("abc"), multi_line=True).load([tmp_dir])
    assert read(got) == read(want)


def test_open_quotes_and_short_rows_fail(spark, tmp_dir):
    write_text(f"{tmp_dir}/open/f.csv", 'a,b,c\n1,"2,3\n4,5,6\n')
    with pytest.raises(Exception, match="inside quotes"):
        multiline.read_records(spark, [f"{tmp_dir}/open"], ingest.text_schema("abc"), OPTIONS).collect()
    write_text(f"{tmp_dir}/short/f.csv", 'a,b,c\n1,"2\n"\n4,5,6\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        multiline.read_records(spark, [f"{tmp_dir}/short"], ingest.text_schema("abc"), OPTIONS).collect()
    schema, opts = ingest.csv_format("abc", on_error="continue")
    kept = multiline.read_records(spark, [f"{tmp_dir}/short"], schema, opts).collect()
    assert sorted((r.a, r[ingest.CORRUPT]) for r in kept) == [("1", '1,"2\n"'), ("4", None)]


def test_empty_file_and_header_only(spark, tmp_dir):
    write_text(f"{tmp_dir}/e.csv", "")
    write_text(f"{tmp_dir}/h.csv", "a,b,c\n")
    assert multiline.read_records(spark, [tmp_dir], ingest.text_schema("abc"), OPTIONS).count() == 0


def test_content_key_follows_bytes_not_ranges(spark, tmp_dir):
    body = "".join(f"{i},line é {i * i}\n" for i in range(2000))
    swapped = body.replace("3,line é 9\n4,line é 16\n", "4,line é 16\n3,line é 9\n", 1)
    for name, text in (("a b+1", body), ("same", body), ("cut", body[:-1]), ("other", body.replace("7,", "8,", 1)), ("swapped", swapped)):
        write_text(f"{tmp_dir}/{name}.csv", text)

    def keys():
        return {os.path.basename(r.path): r.content_key for r in ingest.content_keys(spark, [tmp_dir]).collect()}

    whole = keys()
    kept = {k: spark.conf.get(k) for k in RANGES}
    try:
        for k, v in RANGES.items():
            spark.conf.set(k, v)
        assert keys() == whole
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert whole["a b+1.csv"] == whole["same.csv"] and len(set(whole.values())) == 4


def test_same_bytes_again_load_nothing(spark, tmp_dir):
    e = entities.LOCATION
    head = "locationid,city,state,zipcode,activeflag,createddate,modifieddate\n"
    line = "{},Pune,Maharashtra,411001,Yes,2024-01-01 09:00:00,\\N\n"
    path = write_text(f"{tmp_dir}/in/f.csv", head + line.format(1))
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    assert batch.copy_into(wh, e, f"{tmp_dir}/in").rows == 1
    os.utime(path, (1, 2_000_000_000))
    assert batch.copy_into(wh, e, f"{tmp_dir}/in") == batch.LoadResult(None, 0, 0)
    assert batch.copy_into(wh, e, f"{tmp_dir}/in") == batch.LoadResult(None, 0, 0)
    assert wh.ledger.loads().filter("status = 'SKIPPED'").count() == 1
    # Other bytes under the same name, and the same bytes under another name, are loaded.
    write_text(path, head + line.format(2))
    write_text(f"{tmp_dir}/in/g.csv", head + line.format(1))
    assert batch.copy_into(wh, e, f"{tmp_dir}/in").files == 2
    assert sorted(r.locationid for r in wh.stage(e).collect()) == ["1", "1", "2"]


def test_directory_lists_changed_prefixes_only(spark, tmp_dir, monkeypatch):
    from tierflow.sources.directory import Directory

    land = f"{tmp_dir}/land"
    for n in range(6):
        write_text(f"{land}/day {n}/f.csv", "a\n" * (n + 1))
    write_text(f"{land}/top.csv", "a\n")
    d = Directory(spark, land, f"{tmp_dir}/dir", buckets=3)
    asked = []
    real = ingest.list_files
    monkeypatch.setattr(ingest, "list_files", lambda spark, path, *a: asked.append(path) or real(spark, path, *a))

    def same():
        monkeypatch.setattr(ingest, "list_files", real)
        assert sorted(map(tuple, d.files().collect())) == sorted(map(tuple, real(spark, land).collect()))
        monkeypatch.setattr(ingest, "list_files", lambda spark, path, *a: asked.append(path) or real(spark, path, *a))

    assert d.refresh() == [f"day {n}" for n in range(6)]
    same()
    write_text(f"{land}/day 2/more.csv", "b\n")
    write_text(f"{land}/day 9/f.csv", "b\n")
    os.remove(f"{land}/day 4/f.csv")
    os.rmdir(f"{land}/day 4")
    os.utime(f"{land}/day 2", (1, 2_000_000_000))
    asked.clear()
    assert d.refresh() == ["day 2", "day 9"]
    assert [[p.removeprefix(land) for p in paths] for paths in asked] == [["/day 2", "/day 9", "/top.csv"]]
    same()
    os.remove(f"{land}/top.csv")
    assert d.refresh() == []
    same()
    version = d.table.version()
    assert d.refresh() == [] and d.table.version() == version
    assert len(d.refresh(full=True)) == 6
    same()


def test_load_from_a_kept_listing(spark, tmp_dir):
    from tierflow.sources.directory import Directory

    e = entities.LOCATION
    head = "locationid,city,state,zipcode,activeflag,createddate,modifieddate\n"
    write_text(f"{tmp_dir}/in/d1/f.csv", head + "1,Pune,Maharashtra,411001,Yes,2024-01-01 09:00:00,\\N\n")
    d, wh = Directory(spark, f"{tmp_dir}/in", f"{tmp_dir}/dir", buckets=2), batch.Warehouse(spark, f"{tmp_dir}/wh")
    d.refresh()
    assert batch.copy_into(wh, e, f"{tmp_dir}/in", listing=d.files()).rows == 1
    assert batch.copy_into(wh, e, f"{tmp_dir}/in", listing=d.files()).rows == 0


def test_rounds_of_files(spark, tmp_dir):
    e = entities.LOCATION
    head = "locationid,city,state,zipcode,activeflag,createddate,modifieddate\n"
    for i in range(5):
        write_text(f"{tmp_dir}/in/f{i}.csv", head + f"{i},Pune,Maharashtra,411001,Yes,2024-01-01 09:00:00,\\N\n")
    wh = batch.Warehouse(spark, f"{tmp_dir}/wh")
    done = batch.copy_into(wh, e, f"{tmp_dir}/in", max_files=2)
    assert (done.files, done.rows) == (5, 5) and wh.ledger.committed_batches(e.name).count() == 3
