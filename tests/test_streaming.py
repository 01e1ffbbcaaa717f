"""STR-1/STR-2: tags are per post, nothing is lost, and a replay adds nothing."""
import datetime as dt
import json
import os

from conftest import rows
from quayside.session import work_dir
from quayside.streaming import ingest

TS = dt.datetime(2024, 3, 5, 6, 7, 8)


def land(base, name, items):
    os.makedirs(os.path.dirname(f"{base}/landing/{name}"), exist_ok=True)
    with open(f"{base}/landing/{name}", "w") as f:
        f.write(items if isinstance(items, str) else json.dumps(items))


def test_posts_of_one_micro_batch_are_tagged_apart(spark):
    base = work_dir(spark, "inv")
    land(base, "one.json", [{"Sales_Document": d} for d in "ABABCA"])
    land(base, "two.json", [{"Sales_Document": d} for d in "ABA"] + [{"File_Name": "lost.pdf"}, {"Sales_Document": None}])
    land(base, "three.json", "this is no array")
    args = (f"{base}/landing", f"{base}/out", f"{base}/ckpt", TS)
    ingest.invoice_stream(spark, *args).awaitTermination()
    out = ingest.read_output(spark, f"{base}/out")
    got = {}
    for r in out.orderBy("post", "pos").collect():
        got.setdefault(r["post"].split("/")[-1], []).append(r["Dup_Value"])
    assert got == {"one.json": [1, 1, 2, 3, 1, 4], "two.json": [1, 1, 2]}
    assert out.first()["Date_Created"] is None  # absent key → null
    bad = spark.read.parquet(f"{base}/out_quarantine")
    assert sorted((p.split("/")[-1], raw) for p, raw in rows(bad, "post", "raw")) == [
        ("three.json", "this is no array"), ("two.json", '{"File_Name":"lost.pdf"}'), ("two.json", '{"Sales_Document":null}')]
    ingest.invoice_stream(spark, *args).awaitTermination()
    assert ingest.read_output(spark, f"{base}/out").count() == 9


def test_a_new_checkpoint_overwrites_nothing(spark):
    base = work_dir(spark, "inv2")
    land(base, "one.json", [{"Sales_Document": "A"}])
    ingest.invoice_stream(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", TS).awaitTermination()
    land(f"{base}/next", "two.json", [{"Sales_Document": "B"}])
    ingest.invoice_stream(spark, f"{base}/next/landing", f"{base}/out", f"{base}/ckpt2", TS).awaitTermination()
    assert sorted(rows(ingest.read_output(spark, f"{base}/out"), "Sales_Document")) == [("A",), ("B",)]


def test_syslog_stream_quarantines_objects_without_id(spark):
    base = work_dir(spark, "log")
    land(base, "p", [{"Sales_Document": "7", "SAP_Shipment": "S1"}, {"SAP_Shipment": "7"},
                     {"Sales_Document": None, "SAP_Shipment": "S2"}, {"Error_Message": "x"}])
    ingest.syslog_stream(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", TS).awaitTermination()
    out = ingest.read_output(spark, f"{base}/out").orderBy("pos").collect()
    assert [(r["log_id"], r["Dup_Value"]) for r in out] == [("7", 1), ("7", 2)]
    assert spark.read.parquet(f"{base}/out_quarantine").count() == 2


def test_posts_of_one_name_in_two_folders_stay_apart(spark):
    base = work_dir(spark, "two")
    for day in ("day=1", "day=2"):
        land(base, f"{day}/one.json", [{"Sales_Document": "A"}, {"Sales_Document": "A"}])
    ingest.invoice_stream(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", TS).awaitTermination()
    out = ingest.read_output(spark, f"{base}/out")
    assert sorted(rows(out, "Dup_Value")) == [(1,), (1,), (2,), (2,)]
    assert out.select("post").distinct().count() == 2
