"""Sources, sinks, build plans and streaming ingest."""

import uuid

from vendorlens.plans import tables as tb
from vendorlens.plans.build import BUILD_TABLES, build_final_tables, build_notebook_tables
from vendorlens.session import checkpoint_dir
from vendorlens.sources import files as S
from vendorlens.streaming.ingest import run_ingest


def _tmp(spark):
    return f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex[:8]}"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_load_raw_data_keeps_files_with_odd_cells(spark, sf_dir):
    root = _tmp(spark)
    b = tb.base(spark, sf_dir)
    S.export_csvs({"sales": b.sales}, f"{root}/raw")
    with open(f"{_local(root)}/raw/vendor_invoice.csv", "w") as f:
        f.write("VendorNumber,PONumber,Quantity,Dollars,Freight\n1,10,5,2.5,NA\n2,11,6.0,3.5,0.1\n3,12,x,4.5,#N/A\n4,13, 7 ,nan,1e2\n")
    rep = {r["table"]: r for r in S.load_raw_data(spark, f"{root}/raw", f"{root}/out").collect()}
    assert rep["sales"]["status"] == "ok" and rep["sales"]["rows"] == b.sales.count() and rep["sales"]["error"] is None
    assert rep["vendor_invoice"]["status"] == "ok" and rep["vendor_invoice"]["error"] == "Quantity: 1 not parsed"
    got = sorted(map(tuple, spark.table("vendor_invoice").collect()))
    assert got == [(1, 10, 5, 2.5, None), (2, 11, 6, 3.5, 0.1), (3, 12, None, 4.5, None), (4, 13, 7, None, 100.0)]


def test_failed_reload_leaves_the_old_table(spark):
    root = _tmp(spark)
    import os
    os.makedirs(f"{_local(root)}/raw")
    path = f"{_local(root)}/raw/vendor_invoice.csv"
    with open(path, "w") as f:
        f.write("VendorNumber,PONumber,Quantity,Dollars,Freight\n1,10,5,2.5,0.5\n")
    assert S.load_raw_data(spark, f"{root}/raw", f"{root}/out").first()["status"] == "ok"
    with open(path, "w") as f:
        f.write("Vendor,Other\n1,2\n")
    assert S.load_raw_data(spark, f"{root}/raw", f"{root}/out").first()["status"] == "error"
    assert [tuple(r) for r in spark.table("vendor_invoice").collect()] == [(1, 10, 5, 2.5, 0.5)]


def test_build_and_export_round_trip(spark, sf_dir):
    root = _tmp(spark)
    t = build_final_tables(spark, tb.base(spark, sf_dir), out_dir=f"{root}/t", csv_dir=f"{root}/csv")
    assert set(BUILD_TABLES) <= set(t)
    v = S.validate_exports(spark, f"{root}/csv")
    rows = {r["file"]: r["rows"] for r in v.select("file", "rows").distinct().collect()}
    assert rows == {n: t[n].count() for n in BUILD_TABLES}
    nb = build_notebook_tables(spark, tb.base(spark, sf_dir), out_dir=f"{root}/t")
    assert nb["final_all"].count() == nb["final_vendor"].count() + nb["final_brand"].count()


def test_stream_ingest_is_exactly_once(spark, sf_dir):
    root = _tmp(spark)
    b = tb.base(spark, sf_dir)
    S.export_csvs({"purchases": b.purchases}, f"{root}/drop")
    ck = f"{root}/ckpt"
    first = run_ingest(spark, f"{root}/drop/purchases.csv", "purchases", f"{root}/table", checkpoint=ck).count()
    again = run_ingest(spark, f"{root}/drop/purchases.csv", "purchases", f"{root}/table", checkpoint=ck).count()
    assert first == again == b.purchases.count()


def test_catalog_helpers(spark, sf_dir):
    b = tb.base(spark, sf_dir)
    b.sales.createOrReplaceTempView("sales")
    names = [r["name"] for r in S.list_tables(spark).collect()]
    assert "sales" in names
    assert S.require_tables(spark, ["sales"]).count() == 1
    import pytest
    with pytest.raises(RuntimeError, match="nope"):
        S.require_tables(spark, ["sales", "nope"])


def test_replaced_tables_outlive_the_session(spark):
    import os
    import pytest
    from vendorlens.sources import versions as V
    path = f"{_tmp(spark)}/t"
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, path)
    S.ingest(spark.createDataFrame([(1, "a", -2.0), (2, None, 3.0)], "k int, v string, x double"), "versioned", path)
    other = spark.newSession()
    old = V.read_table(other, path)
    assert sorted(map(tuple, old.collect())) == [(1, "a", -2.0), (2, None, 3.0)]
    m = V.manifest(other, path)
    assert (m["rows"], m["nulls"], m["negatives"]) == (2, {"k": 0, "v": 1, "x": 0}, {"k": 0, "x": 1})
    with pytest.raises(Exception):  # a write that fails leaves the table
        V.replace_table(spark.range(3).selectExpr("raise_error('no') AS k"), path)
    assert V.read_table(other, path).count() == 2
    V.replace_table(spark.range(5).toDF("k"), path)
    assert V.read_table(other, path).columns == ["k"] and V.read_table(other, path).count() == 5
    assert old.count() == 2  # within the grace period a reader goes on
    V.replace_table(spark.range(0).toDF("k"), path, grace=-1)
    assert V.read_table(other, path).count() == 0
    left = [f for f in os.listdir(_local(path)) if f.startswith("v-")]
    assert len(V.manifests(spark, path)) == 1 and m["version"].rsplit("/", 1)[-1] not in left
    assert V.manifest(spark, path)["version"].rsplit("/", 1)[-1] in left


def test_files_of_one_schema_load_together(spark, monkeypatch):
    import os
    root = _tmp(spark)
    os.makedirs(f"{_local(root)}/raw")

    def put(name, text):
        with open(f"{_local(root)}/raw/{name}.csv", "w") as f:
            f.write(text)

    put("y1", "a,b\n1,x\n2,NA\n")
    put("y2", "a,b\n3,z\n")
    put("y 2", "a,b\n7,q\n8,r\n")
    put("none", "a,b\n")
    put("other", "c\n5\n")
    put("vendor_invoice", "VendorNumber,PONumber,Quantity,Dollars,Freight\n1,10,q,2.5,0.5\n1,z,1,2.5,0.5\n")
    put("purchase_prices", "Vendor,Brand\n1,2\n")
    jobs = []
    load = S._load_together
    monkeypatch.setattr(S, "_load_together", lambda *a: (jobs.append(len(a[2])), load(*a))[1])
    rep = {r["table"]: tuple(r) for r in S.load_raw_data(spark, f"{root}/raw", f"{root}/out").collect()}
    assert sorted(jobs) == [1, 1, 1, 4]
    assert rep["y1"] == ("y1", 2, 2, "ok", None) and rep["none"][1:4] == (0, 2, "ok") and rep["y 2"][1] == 2
    assert rep["vendor_invoice"][1:] == (2, 5, "ok", "PONumber: 1 not parsed, Quantity: 1 not parsed")
    assert rep["purchase_prices"][3] == "error" and rep["other"][1:4] == (1, 1, "ok")
    from vendorlens.sources.versions import read_table
    assert sorted(map(tuple, read_table(spark, f"{root}/out/y1").collect())) == [("1", "x"), ("2", None)]
    assert sorted(map(tuple, spark.table("y2").collect())) == [("3", "z")] and read_table(spark, f"{root}/out/none").count() == 0


def test_first_rows_come_in_file_order(spark):
    root = _tmp(spark)
    df = spark.range(5000).selectExpr("id AS k", "concat('v', id) AS v")
    S.export_csvs({"big": df, "small": df.limit(2)}, root, {"big": [df["k"].desc()], "small": ["k"]})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = S.first_rows(spark, root).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    cells = {(r["file"], r["row"], r["column"]): r["value"] for r in got}
    assert [cells["big", i, "k"] for i in (1, 2, 3)] == ["4999", "4998", "4997"] and cells["small", 2, "v"] == "v1" and len(cells) == 10
