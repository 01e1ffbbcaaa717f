"""Table versions and next-state functions."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.sinks import transitions
from quayside.sinks.state import TableStore


def test_versions_replace_previous_append(spark):
    store = TableStore(spark)
    assert store.current("t") is None
    store.replace("t", spark.createDataFrame([(1,)], "a int"))
    store.replace("t", spark.createDataFrame([(2,), (3,)], "a int"))
    assert store.versions("t") == [1, 2]
    assert sorted(rows(store.current("t"))) == [(2,), (3,)]
    assert rows(store.previous("t")) == [(1,)]
    assert store.replace_unless_empty("t", spark.createDataFrame([], "a int")) is None
    assert store.versions("t") == [1, 2]
    store.append("log", spark.createDataFrame([(1,)], "a int"))
    store.append("log", spark.createDataFrame([], "a int"), only_if_rows=True)
    store.append("log", spark.createDataFrame([(2,)], "a int"))
    assert sorted(rows(store.read_appended("log"))) == [(1,), (2,)]


def test_failed_write_leaves_current_version(spark):
    store = TableStore(spark)
    store.replace("t", spark.createDataFrame([("1",)], "a string"))
    bad = spark.createDataFrame([("x",)], "a string").select(F.col("a").cast("int").alias("a"))
    with pytest.raises(Exception):
        store.replace("t", bad)  # ANSI cast fails inside the job
    assert rows(store.current("t")) == [("1",)]
    store.replace("t", spark.createDataFrame([("2",)], "a string"))  # the table is not stuck
    assert rows(store.current("t")) == [("2",)] and rows(store.previous("t")) == [("1",)]


def test_an_unfinished_version_is_passed_over(spark):
    import os
    store = TableStore(spark)
    store.replace("t", spark.createDataFrame([("1",)], "a string"))
    os.makedirs(f"{store.root}/t/v000002")  # no _SUCCESS: a job was lost here
    store.replace("t", spark.createDataFrame([("2",)], "a string"))
    assert store.versions("t") == [1, 3] and rows(store.current("t")) == [("2",)]


def test_widened_append_keeps_its_columns(spark):
    store = TableStore(spark)
    store.append("w", spark.createDataFrame([(1,)], "a int"))
    out = store.append("w", spark.createDataFrame([(2, "x")], "a int, b string"))
    assert sorted(rows(out, "a", "b")) == [(1, None), (2, "x")]


def test_retain_keeps_current_and_previous(spark):
    import os
    store = TableStore(spark)
    for i in range(4):
        store.replace("t", store.stage("t", spark.range(i, i + 1)))
    store.retain("t")
    assert store.versions("t") == [3, 4] and not os.path.exists(f"{store.root}/t/_staging")
    assert rows(store.current("t")) == [(3,)]


def test_stage_writes_once(spark):
    """A staged frame staged again is returned as it is (no second copy);
    a computed frame is written and read back."""
    import os
    store = TableStore(spark)
    first = store.stage("s", spark.createDataFrame([(1,), (2,)], "a int"))
    staging = f"{store.root}/s/_staging"
    n = len(os.listdir(staging))
    assert store.stage("s", first) is first
    assert len(os.listdir(staging)) == n
    derived = store.stage("s", first.withColumn("b", F.col("a") * 2))
    assert len(os.listdir(staging)) == n + 1
    assert sorted(rows(derived)) == [(1, 2), (2, 4)]


def _exchange_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    names = [f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles())]
    return {n for n in names if n.startswith("shuffle_")}


def test_frames_become_one_version_and_their_exchanges_go(spark):
    """A write deletes its exchanges at its end, not when the driver's garbage is
    collected: else every piece's exchanges are on disk together."""
    import time
    store = TableStore(spark)
    df = spark.range(3000).select((F.col("id") % 700).alias("k")).groupBy("k").count()
    parts = [df.filter(F.col("k") % 3 == i) for i in range(3)]
    table = store.replace("t", parts)
    assert store.versions("t") == [1] and store.rows_of(table) == 700
    assert sorted(rows(table)) == sorted(rows(df))
    assert store.rows_of(store.stage("t", parts)) == 700
    assert sorted(rows(store.append("l", parts))) == sorted(rows(df))
    assert store.append("l", [p.filter("k < 0") for p in parts], only_if_rows=True).count() == 700
    assert store.append("none", [p.filter("k < 0") for p in parts], only_if_rows=True).count() == 0
    had = _exchange_files(spark)
    store.replace("t", parts)
    until = time.time() + 10
    while (left := _exchange_files(spark) - had) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_a_failed_piece_leaves_no_rows(spark):
    store = TableStore(spark)
    good = spark.createDataFrame([("1",)], "a string").select(F.col("a").cast("int").alias("a"))
    bad = spark.createDataFrame([("x",)], "a string").select(F.col("a").cast("int").alias("a"))
    store.append("l", good)
    store.replace("t", good)
    for write in (lambda: store.append("l", [good, bad]), lambda: store.replace("t", [good, bad])):
        with pytest.raises(Exception):
            write()
    assert rows(store.read_appended("l")) == [(1,)] and rows(store.current("t")) == [(1,)]


def test_run_log(spark):
    store = TableStore(spark)
    now = dt.datetime(2024, 3, 5, 5, 50)
    store.log_run("job", "tbl", "Success", 3, now)
    log = store.append("run_log", spark.createDataFrame([], store.RUN_LOG_SCHEMA))
    assert rows(log, "job", "target", "status", "rows", "logged_at") == [("job", "tbl", "Success", 3, now)]


def test_keyed_update_last_request_wins(spark):
    table = spark.createDataFrame([("s", "u", "c", "old"), ("s", "v", "c", "old")],
                                  "ShiptoID string, UniqueID string, ChangedColumn string, Status string")
    req = spark.createDataFrame([("s", "u", "c", "first", 1), ("s", "u", "c", "second", 2), ("s", "w", "c", "none", 1)],
                                "ShiptoID string, UniqueID string, ChangedColumn string, Status string, seq int")
    out = transitions.keyed_update(table, req, ["ShiptoID", "UniqueID", "ChangedColumn"], {"Status": "Status"}, "seq")
    assert sorted(rows(out)) == [("s", "u", "c", "second"), ("s", "v", "c", "old")]


def test_cert_update_dates(spark):
    table = spark.createDataFrame([(1, "n", None, None, None, None, None, None, None)],
                                  "ID long, DocumentName string, DocumentDescription string, Legalization string, "
                                  "LatestDocumentDate date, ExpirationDate date, AlertDate date, Status string, Comment string")
    req = spark.createDataFrame([(1, "m", "d", "y", "2024-02-29", "", None, "S", "c", 2),
                                 (1, "old", "d", "y", "2020-02-29", "", None, "S", "c", 1)],
                                "ID long, DocumentName string, DocumentDescription string, Legalization string, "
                                "LatestDocumentDate string, ExpirationDate string, AlertDate string, Status string, Comment string, "
                                "seq int")
    out = transitions.cert_update(table, req).first()
    assert out["LatestDocumentDate"] == dt.date(2024, 2, 29) and out["ExpirationDate"] is None
    bad = req.withColumn("LatestDocumentDate", F.lit("29/02/2024"))
    with pytest.raises(Exception):
        transitions.cert_update(table, bad).collect()


def test_cert_insert_maps_request_spellings(spark):
    table = spark.createDataFrame([], "ID long, Country string, ShipTo string, DocumentName string, "
                                      "DocumentDescription string, Legalization string, LatestDocumentDate date, "
                                      "ExpirationDate date, AlertDate date, Status string, Comment string")
    req = spark.createDataFrame([("MX", "42", "d", "desc", "No", "2024-01-02", "", None, "New", "c")],
                                "Country string, ShipToID string, DocumentName string, DOcumentDescrption string, "
                                "Legalization string, LastDocumentDate string, ExpirationDate string, AlertDate string, "
                                "Status string, Comment string")
    r = transitions.cert_insert(table, req).first()
    assert (r["ID"], r["ShipTo"], r["DocumentDescription"], r["LatestDocumentDate"], r["ExpirationDate"]) == \
        (None, "42", "desc", dt.date(2024, 1, 2), None)


def test_partial_replace_and_mark_done(spark):
    old = spark.createDataFrame([("p1", "Done"), ("p2", None)], "folder_path string, status string")
    new = spark.createDataFrame([("p3", None), ("p4", None)], "folder_path string, status string")
    state = transitions.partial_replace(old, new)
    assert sorted(rows(state), key=str) == [("p1", "Done"), ("p3", None), ("p4", None)]
    done = transitions.mark_done(state, spark.createDataFrame([("p3",)], "folder_path string"))
    assert sorted(rows(done), key=str) == [("p1", "Done"), ("p3", "Done"), ("p4", None)]
    # applying the same write-back twice changes nothing more
    assert sorted(rows(transitions.mark_done(done, spark.createDataFrame([("p3",)], "folder_path string"))), key=str) \
        == sorted(rows(done), key=str)


def test_prefix_replace_set_wise(spark):
    old = spark.createDataFrame([("4500012345-1", "a"), ("4500012345-2", "a"), ("4500099999-1", "a")], "k string, v string")
    new = spark.createDataFrame([("4500012345-9", "b")], "k string, v string")
    stems = spark.createDataFrame([("4500012345",)], "stem string")
    assert sorted(rows(transitions.prefix_replace(old, new, stems, "k"))) == [("4500012345-9", "b"), ("4500099999-1", "a")]
    files = spark.createDataFrame([("45", 1), ("4500012345", 2), ("", 3)], "stem string, n int")
    new = spark.createDataFrame([("4500012345-9", "one", 1), ("4500012345-9", "two", 2), ("4500077777-1", "one", 1)],
                                "k string, v string, n int")
    assert sorted(rows(transitions.prefix_replace(old, new, files, "k", order_col="n"))) == \
        [("4500012345-9", "two"), ("4500077777-1", "one")]


def test_mail_outcomes_quotes_round_trip(spark):
    q = spark.createDataFrame([("m1", "Ready", "keep", None), ("m2", "Ready", "old", None), ("m3", "Ready", None, None)],
                              "unique_item_id string, send_email_status string, send_email_comment string, date_send_email string")
    o = spark.createDataFrame([("m1", True, None, 2), ("m1", False, "first try", 1), ("m2", False, "it's full", 1)],
                              "unique_item_id string, ok boolean, error_message string, seq int")
    out = {r[0]: tuple(r[1:]) for r in transitions.mail_outcomes(q, o, dt.datetime(2024, 3, 5)).collect()}
    assert out == {"m1": ("Completed", "keep", "05/03/2024"), "m2": ("Error", "it's full", "05/03/2024"),
                   "m3": ("Ready", None, None)}


def test_two_jobs_never_share_a_version(spark):
    """Both read the same greatest number before either commits."""
    one, two = TableStore(spark), None
    two = TableStore(spark, one.root)
    first = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    second = spark.range(7).select(F.col("id").cast("int").alias("a"))
    a, _ = one._write("t", first)
    b, _ = two._write("t", second)
    two._numbers = lambda name: []  # what the second job saw
    assert one._commit("t", a, first.schema).count() == 3
    assert two._commit("t", b, second.schema).count() == 7
    assert one.versions("t") == [1, 2]
    assert one.read("t", 1).count() == 3 and one.read("t", 2).count() == 7


def test_appended_columns_named_like_folders_stay(spark):
    store = TableStore(spark)
    store.append("p", spark.createDataFrame([("x", 1)], "part string, a int"))
    out = store.append("p", spark.createDataFrame([("y", 2, 0.5)], "part string, a int, run double"))
    assert sorted(rows(out, "part", "a", "run")) == [("x", 1, None), ("y", 2, 0.5)]
    with pytest.raises(ValueError):
        store.append("p", spark.createDataFrame([(1,)], "part int"))


def test_compact_keeps_rows_and_columns(spark):
    import os
    store = TableStore(spark)
    for i in range(4):
        store.append("c", spark.createDataFrame([(i,)], "a int"))
    store.append("c", spark.createDataFrame([(9, "z")], "a int, b string"))
    out = store.compact("c")
    assert len([d for d in os.listdir(f"{store.root}/c/append") if d.startswith("part")]) == 1
    assert sorted(rows(out, "a", "b"))[-1] == (9, "z") and out.count() == 5


def test_counts_are_seen_while_writing(spark):
    store = TableStore(spark)
    out = store.replace("n", spark.range(1000).repartition(7).where("id % 3 = 0"))
    assert out._store_rows == store.rows_of(out) == out.count() == 334
    assert store.rows_of(store.stage("n", spark.createDataFrame([], "a int"))) == 0


# ------------------------------------------------------------ keyed tables

def _files(table):
    import os
    return {os.path.join(base, f) for base, _, fs in os.walk(f"{table.path}/rows") for f in fs if f.endswith(".parquet")}


def _alerts(spark):
    df = spark.range(400).select(F.concat(F.lit("s"), F.col("id") % 40).alias("ShiptoID"),
                                 F.col("id").cast("string").alias("UniqueID"), F.lit("Status").alias("ChangedColumn"),
                                 F.lit("Not Started").alias("Status"))
    from quayside.sinks.keyed import KeyedTable
    table = KeyedTable(spark, None, ["UniqueID"], buckets=16)
    table.create(df)
    return table


def test_an_update_rewrites_only_its_partitions(spark):
    from quayside.plans import jobs
    store, table, now = TableStore(spark), _alerts(spark), dt.datetime(2024, 3, 5)
    before = _files(table)
    req = spark.createDataFrame([("s5", "5", "Status", "Done", 1), ("s5", "5", "Status", "Again", 2), ("s6", "7", "Status", "x", 1)],
                                "ShiptoID string, UniqueID string, ChangedColumn string, Status string, seq int")
    out = jobs.alert_status_job(table, store, req, now)
    assert out.count() == 400 and rows(out.where("Status <> 'Not Started'"), "UniqueID", "Status") == [("5", "Again")]
    after = _files(table)
    touched = {f.split("__bucket=")[1].split("/")[0] for f in before - after}
    assert len(touched) == 2 and len(before & after) == len(before) - len(before - after) > 0
    assert [tuple(r) for r in store.read_appended("run_log").select("job", "status", "rows").collect()] == [
        ("alert_status_update", "Success", 3)]


def test_a_failed_update_changes_nothing_and_is_logged(spark):
    from quayside.plans import jobs
    store, table = TableStore(spark), _alerts(spark)
    before = _files(table)
    req = spark.createDataFrame([("s5", "5", "Status", "x", 1)],
                                "ShiptoID string, UniqueID string, ChangedColumn string, Status string, seq int")
    bad = req.withColumn("Status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        jobs.alert_status_job(table, store, bad, dt.datetime(2024, 3, 5))
    assert _files(table) == before
    assert store.read_appended("run_log").first()["status"].startswith("Failed")


def test_an_overwrite_that_was_cut_off_is_finished(spark):
    from quayside.sinks.keyed import KeyedTable
    table = _alerts(spark)
    put, table._put = table._put, lambda staged: (_ for _ in ()).throw(RuntimeError("lost"))
    req = spark.createDataFrame([("5",)], "UniqueID string")
    done = lambda old, r: old.join(r.withColumn("hit", F.lit(1)), "UniqueID", "left").select(
        "ShiptoID", "UniqueID", "ChangedColumn", F.when(F.col("hit") == 1, "Done").otherwise(F.col("Status")).alias("Status"))
    with pytest.raises(RuntimeError):
        table.change(req, done)
    assert table.read().where("Status = 'Done'").count() == 0
    again = KeyedTable(spark, table.path, ["UniqueID"], buckets=16)  # the next job opens the table
    assert rows(again.read().where("Status = 'Done'"), "UniqueID") == [("5",)] and again.read().count() == 400


def test_ids_follow_the_order_without_gaps(spark):
    from quayside.sinks.keyed import with_ids
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("seq"), F.col("id").alias("x")).repartition(9)
    got = with_ids(df, 101, ["seq"])
    assert rows(got.orderBy("seq").limit(2), "seq", "ID") == [(0, 101), (1, 102)]
    assert got.where("ID <> seq + 101").count() == 0 and got.count() == 5000
    assert with_ids(df.limit(0), 1, ["seq"]).collect() == []


def test_certificates_inserted_then_updated_by_their_ids(spark):
    from quayside.plans import jobs
    from quayside.sinks.keyed import KeyedTable
    schema = ("ID long, Country string, ShipTo string, DocumentName string, DocumentDescription string, Legalization string, "
              "LatestDocumentDate date, ExpirationDate date, AlertDate date, Status string, Comment string")
    store, now = TableStore(spark), dt.datetime(2024, 3, 5)
    certs = KeyedTable(spark, None, ["ID"], buckets=4)
    certs.create(spark.createDataFrame([(41, "MX", "1", "old", None, None, None, None, None, "S", None)], schema))
    req = spark.createDataFrame([(2, "FR", "b"), (1, "DE", "a")], "seq int, Country string, ShipToID string").select(
        "*", *[F.lit("").alias(c) for c in ("LastDocumentDate", "ExpirationDate", "AlertDate")],
        *[F.lit("v").alias(c) for c in ("DocumentName", "DOcumentDescrption", "Legalization", "Status", "Comment")])
    out = jobs.cert_insert_job(certs, store, req, now)
    assert sorted(rows(out, "ID", "Country")) == [(41, "MX"), (42, "DE"), (43, "FR")]
    upd = spark.createDataFrame([(43, "new", "2024-02-29", 1)], "ID long, DocumentName string, LatestDocumentDate string, seq int").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("ExpirationDate", "AlertDate")],
        *[F.lit("w").alias(c) for c in ("DocumentDescription", "Legalization", "Status", "Comment")])

    def listed(table):
        return table.select(F.col("Country").alias("country"), "ShipTo", *[F.lit("k").alias(c) for c in (
            "Region", "SoldTo", "payer", "shipping", "customer_status")], F.col("ID").cast("string").alias("ID"), "DocumentName",
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (
                "DocumentDescription", "Legalization", "LatestDocumentDate", "ExpirationDate", "AlertDate", "Status", "Comment")],
            F.explode(F.array(F.lit("BR1"), F.lit("BR0"))).alias("sales_organization"))
    lst = jobs.cert_update_job(certs, store, upd, now, listed)
    assert sorted(rows(lst, "ID", "DocumentName", "LatestDocumentDate", "sales_organization")) == [
        ("41", "old", "", "BR0;BR1"), ("42", "v", "", "BR0;BR1"), ("43", "new", "2024-02-29", "BR0;BR1")]
    log = store.read_appended("run_log")
    assert sorted(rows(log, "job", "rows")) == [("cert_insert", 2), ("cert_update", 1)]
