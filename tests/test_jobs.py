"""Job compositions on FIXTURES cases."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.operators.projections import SchemaMismatch
from quayside.plans import jobs

NOW = dt.datetime(2024, 3, 5, 6, 7, 8)
LOOKUP = [("O", "Ocean"), ("T", "Truck"), ("A", "Air")]


def lookup(spark):
    return spark.createDataFrame(LOOKUP, "shipping_condition string, shipping string")


def test_mail_ready_cases(spark):
    cols = ("sales_order_number unique_item_id export_zone_flow shipping_conditions subject documentation_agent "
            "customer_contact folder_path send_email_comment send_email_status date_send_email").split()
    base = dict(sales_order_number="1", export_zone_flow="z", subject="s", documentation_agent="d",
                send_email_comment=None, send_email_status="Ready", date_send_email=None, folder_path="F")
    cases = [dict(unique_item_id="u1", shipping_conditions="O", customer_contact="a@x.y; b@x.y;"),
             dict(unique_item_id="u1", shipping_conditions="O", customer_contact="a@x.y; b@x.y;"),  # duplicate
             dict(unique_item_id="u2", shipping_conditions="T", customer_contact="a;;", folder_path=None),
             dict(unique_item_id="u3", shipping_conditions="A", customer_contact="-"),
             dict(unique_item_id="u4", shipping_conditions="?", customer_contact=None),
             dict(unique_item_id="u5", shipping_conditions="?", customer_contact="c")]
    data = [tuple({**base, **c}[k] for k in cols) for c in cases]
    q = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    out = {r["unique_item_id"]: (r["Booking/PO_name"], r["customer_contact"], r["folder_path"])
           for r in jobs.mail_ready(q, lookup(spark)).collect()}
    assert jobs.mail_ready(q, lookup(spark)).count() == 3
    assert out == {"u1": ("Booking number", "a@x.y;b@x.y", "Shared%20Documents/F"),
                   "u2": ("PO number", "a;", "Shared%20Documents/"),
                   "u5": (None, "c", "Shared%20Documents/F")}


def test_zip_bundles_cases(spark):
    q = [("1", "b", "p", "O", "R/Shipments/C/1-N/Ocean/BK1", "Ready"),
         ("2", "b", "p", "O", "R/Shipments/C/Ocean", "Ready"),
         ("3", "b", "p", "T", "R/Truck/C/Ocean/BK2", "Ready"),
         ("4", "b", "p", "T", "R/Truck/PO4", "Ready"),
         ("5", "b", "p", "T", "R/Truck/PO5", "Ready"),
         ("6", "b", "p", "T", "R/Truck/PO6", "Done")]
    schema = ("sales_order_number string, booking_number string, customer_purchase_order_number string, "
              "shipping_conditions string, folder_path string, {} string")
    tickets = spark.createDataFrame(q, schema.format("ticket_upload_status"))
    mails = spark.createDataFrame(q[:1], schema.format("send_email_status"))  # in both sources: once
    listing = spark.createDataFrame([
        ("R/Shipments/C/1-N/Ocean/BK1", "b.PDF"), ("R/Shipments/C/1-N/Ocean/BK1", "a.pdf"),
        ("R/Shipments/C/Ocean", "a.pdf"), ("R/Truck/C/Ocean/BK2", "x.pdf"),
        ("R/Truck/PO4", "x.pdf"), ("R/Truck/PO4", "PO4.zip"), ("R/Truck/PO5", "notes.txt"),
        ("R/Truck/PO6", "x.pdf")], "folder_path string, file_name string")
    out = sorted(rows(jobs.zip_bundles(tickets, mails, lookup(spark), listing)))
    assert out == [("R/Shipments/C/1-N/Ocean/BK1", "BK1.zip", ["a.pdf", "b.PDF"]),
                   ("R/Truck/C/Ocean/BK2", "BK2.zip", ["x.pdf"]), ("R/Truck/C/Ocean/BK2", "C.zip", ["x.pdf"])]


def test_file_routing_cases(spark):
    blobs = spark.createDataFrame([("A.PDF.pdf",), ("0012345678.pdf",), ("nofolder.pdf",), ("skip.txt",), ("inv_x.pdf",), (".pdf",)],
                                  "name string")
    invoices = spark.createDataFrame([("a_1.pdf", "0012345678"), ("a_2.pdf", "4512345678"),
                                      ("0012345678.pdf", "0012345678"), ("nofolder.pdf", "99"),
                                      ("invAx.pdf", "0012345678")], "file_name string, Sales_Document string")
    folders = spark.createDataFrame([("12345678", "R/S/1"), ("12345678", "R/S/1"), ("4512345678", "R/S/2"),
                                     ("99", None)], "sales_order_number string, folder_path string")
    out = sorted(rows(jobs.file_routing(blobs, invoices, folders, dt.date(2024, 3, 5)), "name", "route", "target"),
                 key=str)
    dated = "TEST/INV_PLTesting/Prod05032024/"
    assert out == sorted([("A.PDF.pdf", "dated", dated), ("A.PDF.pdf", "folder", "R/S/1"), ("A.PDF.pdf", "folder", "R/S/2"),
                          ("0012345678.pdf", "dated", dated), ("0012345678.pdf", "folder", "R/S/1"),
                          ("nofolder.pdf", "dated", dated), ("nofolder.pdf", "unrouted", None),
                          ("inv_x.pdf", "dated", dated), ("inv_x.pdf", "unrouted", None),
                          (".pdf", "dated", dated), (".pdf", "quarantine", None)], key=str)


def test_customer_docs_width_and_filters(spark):
    cols = [f"c{i}" for i in range(36)]
    data = [tuple(["Z", *["v"] * 5, 1, *["v"] * 29]), tuple(["Not found", *["v"] * 5, 2, *["v"] * 29]),
            tuple([None, *["v"] * 5, 3, *["v"] * 29]), tuple(["Z", *["v"] * 5, 29744324, *["v"] * 29]),
            tuple(["Z", *["v"] * 5, None, *["v"] * 29])]
    df = spark.createDataFrame(data, ", ".join(f"{c} {'bigint' if i == 6 else 'string'}" for i, c in enumerate(cols)))
    out = jobs.customer_docs(df)
    assert out.columns == list(jobs.DOC_COLUMNS)
    assert sorted(rows(out, "ship_to_number"), key=str) == [("1",), (None,)]
    with pytest.raises(SchemaMismatch):
        jobs.customer_docs(df.drop("c35"))


def test_freight_baf_and_newlines(spark):
    df = spark.createDataFrame([tuple(f"a\nb{i}" for i in range(37))], ", ".join(f"c{i} string" for i in range(37)))
    out = jobs.customer_freight(df)
    assert len(out.columns) == 38 and out.columns[29] == "BAF"
    r = out.first()
    assert r["BAF"] == r["sea_freight"] == "a b28"


def test_delivery_report_modes(spark):
    cols = list(jobs.REPORT_ORDER)
    def row(material, invoice, pallets, po_date):
        v = {c: "t" for c in cols}
        v.update({"Material": material, "Invoice": invoice, "Number of Pallets": pallets, "PO Date": po_date})
        for c in jobs.REPORT_DOUBLE:
            v[c] = "1.5"
        return tuple(v[c] for c in cols)
    df = spark.createDataFrame([row("100.0", None, "2", "2024-01-02"), row("5070", "1.0", None, "zz")],
                               ", ".join(f"`{c}` string" for c in cols))
    good, bad = jobs.delivery_report(df, "compat")
    r = good.first()
    assert (r["Material"], r["Invoice"], r["Number of Pallets"], r["PO Date"], r["Qty Delivered"]) == ("1", "", 2, "2024-01-02", 1.5)
    b = bad.first()  # raw cells, as they came
    assert bad.count() == 1 and b["PO Date"] == "zz" and b["Material"] == "5070"
    serial = jobs.delivery_report(spark.createDataFrame([row("1", None, "99999999999", "45000"), row("1", "1", "2", "45000.5")],
                                                        df.schema))
    assert serial[0].first()["PO Date"] == "2023-03-15" and serial[0].count() == 1
    assert serial[1].first()["Number of Pallets"] == "99999999999"
    good, _ = jobs.delivery_report(df, "exact")
    r = good.first()
    assert (r["Material"], r["Invoice"]) == ("100", None)
    with pytest.raises(ValueError):
        jobs.delivery_report(df, "exact", strict=True)
    with pytest.raises(SchemaMismatch):
        jobs.delivery_report(df.drop("Invoice"))


def test_proforma_serial_and_marca(spark):
    src = {k: "x" for k in jobs.PROFORMA_COLUMNS}
    src.update({"Fecha facturacion": 45000.75, "Marca": "1.05", "Cartones": "3", "Importe Neto": "10.456",
                "kilos": "1", "Peso bruto": "2"})
    df = spark.createDataFrame([tuple(src.values()) + ("extra",)],
                               ", ".join(f"`{k}` {'double' if k == 'Fecha facturacion' else 'string'}" for k in src) + ", extra string")
    r = jobs.proforma(df, "compat").first()
    assert r["Fecha_facturacion"] == dt.date(2023, 3, 15) and r["Marca"] == "15" and r["Cartones"] == 3
    assert str(r["Importe_Neto"]) == "10.46"
    assert jobs.proforma(df, "exact").first()["Marca"] == "1.05"


def test_folder_paths_strip_and_null_region(spark):
    cols = "sales_order_number booking_number po_number shipp_condition shipto_number shipto_name shipto_country region OTdata status".split()
    data = [("1", "b", "p", "Ocean", "42", "A–B-C/D (x) & é", "Mé.xico", "AMER", "OT-1;", None),
            ("2", "b", "p", "Ocean", "42", "n", "c", None, "OT", None)]
    out = jobs.folder_paths(spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)))
    assert rows(out, "folder_path", "shipto_name") == [("AMER/Shipments/México/42-ABCD (x) & é/Ocean/OT1", "ABCD (x) & é")]
    assert "OTdata" not in out.columns


def test_options(spark):
    cust = spark.createDataFrame([("1", 'Acme "X"', "UN", "Active"), ("2", "B--C", "UN", "Inactive"),
                                  ("3", None, "UN", "Active"), ("4", "D", "UN", "Blocked")],
                                 "ship_to string, ship_to_name string, ship_to_country string, customer_status string")
    codes = spark.createDataFrame([("UN", "UNITED KINGDOM"), ("UN", "UNITED STATES//")], "alpha_2code string, country_name string")
    dest = sorted(rows(jobs.destination_options(cust, codes), "value"))
    assert dest == [("UNITED KINGDOM",), ("UNITED STATES",)]
    opts = rows(jobs.shipto_options(cust, codes))
    assert opts[:2] == [("UNITED KINGDOM", "B-C-2", "B-C-2"), ("UNITED KINGDOM", "Acme X-1", "Acme X-1")]
    assert [o[0] for o in opts] == sorted(o[0] for o in opts)
    ship = {r["country"]: r["options"] for r in jobs.nested_options_json(jobs.shipto_options(cust, codes)).collect()}
    assert ship["UNITED KINGDOM"] == '[{"value":"B-C-2","label":"B-C-2"},{"value":"Acme X-1","label":"Acme X-1"}]'


def test_file_routing_looks_folders_up_before_prefixes(spark):
    """Repeated and null rows against brute force; a folder is looked up once an
    invoice, and a blob's name enters after equal targets of its stem have met."""
    names = ["inv_1.pdf", "inv_1.pdf", "a/inv_1.PDF", "inv_12.pdf", "inv_9.pdf", ".pdf", "x.txt", None]
    inv = [("inv_12.pdf", "00123"), ("inv_12.pdf", "00123"), ("inv_1.pdf", "7"), ("inv_13", "8"), (None, "7"), ("inv_9", None), ("inv_9", "5")]
    fold = [("00123"[-8:], "F1"), ("7", "F2"), ("7", "F3"), ("8", "F2"), ("5", None), (None, "F9")]
    out = jobs.file_routing(spark.createDataFrame([(n,) for n in names], "name string"),
                            spark.createDataFrame(inv, "file_name string, Sales_Document string"),
                            spark.createDataFrame(fold, "sales_order_number string, folder_path string"), dt.date(2024, 3, 5))
    pdf = [n for n in names if n and n.lower().endswith(".pdf")]
    want, hit = [(n, "dated", "TEST/INV_PLTesting/Prod05032024/") for n in pdf], set()
    for n in pdf:
        stem = n.lower().replace(".pdf", "")
        hit |= {(n, "folder", p) for f, d in inv if stem and f and f.startswith(stem) for k, p in fold
                if p and d and k == (d[-8:] if d[:2] == "00" else d)}
    want += [*hit, *((n, "quarantine" if n == ".pdf" else "unrouted", None) for n in pdf if n not in {h[0] for h in hit})]
    assert sorted(rows(out, "name", "route", "target"), key=str) == sorted(want, key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    cut = next(k for k, line in enumerate(plan) if "explode" in line)
    assert any("sales_order_number" in x and "Join" in x and depth(x) > depth(plan[cut]) for x in plan[cut:])


def test_options_are_dealt_before_they_multiply(spark):
    """Every code of a name counts once, and no task gathers options of its own
    input: they meet in one exchange, by range."""
    cust = spark.createDataFrame([(str(i % 40), f"N{i % 20}", "AB"[i % 2], "Active") for i in range(80)],
                                 "ship_to string, ship_to_name string, ship_to_country string, customer_status string")
    cust = cust.unionByName(cust.withColumn("ship_to_country", F.lit("B")))
    codes = spark.createDataFrame([(c, n) for c in "AB" for n in ("X", "Y", f"only {c}", None)] + [("A", "X")],
                                  "alpha_2code string, country_name string")
    opts = jobs.shipto_options(cust, codes)
    got = rows(opts, "country", "value")
    stored = [(f"N{i % 20}-{i % 40}", {"AB"[i % 2], "B"}) for i in range(40)]
    want = [(n, v) for v, at in stored for n in ("X", "Y", None, *(f"only {c}" for c in at))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda x: x or "")
    for n in ("X", "only B"):
        assert [g[1] for g in got if g[0] == n] == sorted((g[1] for g in got if g[0] == n), reverse=True)
    plan = opts._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [k for k, line in enumerate(plan) if "rangepartitioning" in line]
    assert len(dealt) == 1 and "Project" in plan[dealt[0] + 1] and "Join" in plan[dealt[0] + 2]
    assert sum("REPARTITION_BY_NUM" in line for line in plan) == 2


def test_tag_invoices_defaults_and_stamp(spark):
    df = spark.createDataFrame([("A", 0), ("A", 1)], "Sales_Document string, pos long")
    tagged, bad = jobs.tag_invoices(df.unionByName(spark.createDataFrame([(None, 2)], df.schema)),
                                    dt.datetime(2024, 3, 5, 6, 7, 8))
    assert rows(bad, "pos") == [(2,)]
    out = tagged.orderBy("pos").collect()
    assert [r["UniqueValue"] for r in out] == ["A-0503060708-1", "A-0503060708-2"]
    assert all(out[0][c] is None for c in jobs.INVOICE_DEFAULTED)


def test_load_table_logs_and_quarantines(spark):
    from quayside.sinks.state import TableStore
    store = TableStore(spark)
    rows_in = spark.createDataFrame([("1", "2.5"), ("x", "1")], "id string, amount string")
    table, rejected = jobs.load_table(store, "erp", rows_in, {"id": "bigint", "amount": "double"}, "load_erp",
                                      dt.datetime(2024, 3, 5))
    assert rows(table) == [(1, 2.5)] and rejected.count() == 1
    log = spark.read.parquet(f"{store.root}/run_log/append")
    assert rows(log, "target", "rows") == [("erp", 1)]
    assert rows(store.read_appended("erp_rejected"), "id") == [("x",)]


def test_shipment_alerts_two_days(spark):
    from quayside.sinks.state import TableStore
    store = TableStore(spark)
    cols = ["v"]
    day1 = spark.createDataFrame([("s", "u", "a"), ("s", "w", "x")], "ShiptoID string, UniqueID string, v string")
    day2 = spark.createDataFrame([("s", "u", "a"), ("s", "u", "b"), ("s", "w", "x")], "ShiptoID string, UniqueID string, v string")
    assert jobs.shipment_alerts(store, day1, cols).count() == 0
    ch = jobs.shipment_alerts(store, day2, cols)
    assert rows(ch) == [("s", "u", "v", "a", "a;b")]


def test_shipment_alerts_in_pieces(spark):
    """Pieces change no row, null and blank keys included, and one piece of the
    keys is dealt at a time."""
    from quayside.sinks.state import TableStore
    keys = [None, "", " ", *"abcdefgh"]
    data = [(keys[i % 11], keys[i * 7 % 11], str(i * 5 % 13), f"v{i % 4}") for i in range(300)]
    day1 = spark.createDataFrame(data, "ShiptoID string, UniqueID string, v string, w string")
    day2 = day1.withColumn("w", F.when(F.col("v") != "3", F.col("w")))

    def run(n, given):
        store, dealt = TableStore(spark), []
        was = store._counted

        def counted(df, *rest):
            for frame in df if isinstance(df, list) else [df]:
                dealt.append(frame.count())
            return was(df, *rest)
        store._counted = counted
        jobs.shipment_alerts(store, day1, ["v", "w"], **given)
        changes = jobs.shipment_alerts(store, day2, ["v", "w"], **given)
        return sorted(rows(store.current("alert_D0"))), sorted(rows(changes)), dealt[:n]
    whole, pieces = run(1, {}), run(4, {"pieces": 4})
    assert whole[:2] == pieces[:2] and whole[0] and whole[1]
    assert sum(pieces[2]) == whole[2][0] and max(pieces[2]) < whole[2][0] / 2


def test_shipments_in_pieces_are_the_whole_extract(spark, tmp_path, monkeypatch):
    """Each line item is in one piece, lines without an order and orders without
    lines in none, and the alert job stages the extract once for both days."""
    from quayside.plans import analogues
    ts = dt.datetime(1995, 1, 2)
    made = {
        "lineitem": ([(i % 40 if i % 9 else None, i % 7, i % 5, i % 4 + 1, float(i % 50), i % 10 / 100, "RAN"[i % 3], "OF"[i % 2], ts) for i in range(400)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double,"
                     " l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(k, k % 6 or None, "OFP"[k % 3], ["1-URGENT", "4-NOT SPECIFIED", "5-LOW"][k % 3 if k % 5 else 0]) for k in range(5, 50)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "part": ([(k, f"type {k}", k * 3, f"brand {k % 2}") for k in [*range(7), 3]], "p_partkey long, p_type string, p_size int, p_brand string"),
        "customer": ([(k, k % 3) for k in range(4)], "c_custkey long, c_nationkey int"),
        "nation": ([(k, f"land {k}", k) for k in range(2)], "n_nationkey int, n_name string, n_regionkey int")}
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    whole = analogues.src(spark, str(tmp_path), analogues.SHIPMENT_ROWS_SQL)
    one = sorted(rows(analogues.QUERIES["shipment_alerts"](spark, str(tmp_path))))
    monkeypatch.setattr(analogues, "PIECE_BYTES", 100)
    parts = analogues.src_pieces(spark, str(tmp_path), analogues.SHIPMENT_ROWS_SQL, "lineitem", "l_orderkey")
    assert len(parts) == analogues.MOST_PIECES
    got = [rows(p) for p in parts]
    assert sorted(sum(got, []), key=str) == sorted(rows(whole), key=str) and max(map(len, got)) < whole.count()
    assert one and sorted(rows(analogues.QUERIES["shipment_alerts"](spark, str(tmp_path)))) == one


def test_insert_overwrite_replaces_rows(spark):
    import uuid

    from quayside.session import work_dir
    spark.createDataFrame([(1,), (2,)], "k int").createOrReplaceTempView("io_src")
    name = f"io_{uuid.uuid4().hex[:6]}"
    loc = work_dir(spark, name) + "/t"
    jobs.insert_overwrite(spark, name, loc, "SELECT k FROM io_src")
    out = jobs.insert_overwrite(spark, name, loc, "SELECT k * 10 AS k FROM io_src WHERE k = :k", {"k": 2})
    assert rows(out) == [(20,)]


def test_stored_text_runner_isolates_failures(spark):
    from quayside.sinks.state import TableStore
    store = TableStore(spark)
    spark.createDataFrame([(1,), (2,)], "k int").createOrReplaceTempView("ct_src")
    out = jobs.run_stored_texts(spark, store, {"DMS_a": "SELECT k FROM ct_src", "DMS_b": "SELECT nope FROM ct_src",
                                               "DMS_c": "SELECT k FROM ct_src WHERE k > :m"},
                                "control_tables", dt.datetime(2024, 3, 5), args={"m": 1})
    assert sorted(out) == ["DMS_a", "DMS_c"] and rows(out["DMS_c"]) == [(2,)]
    log = {r["target"]: (r["status"], r["rows"]) for r in spark.read.parquet(f"{store.root}/run_log/append").collect()}
    assert log["DMS_a"] == ("Success", 2) and log["DMS_b"][0].startswith("Failed") and log["DMS_b"][1] is None


def test_refresh_unless_empty(spark):
    from quayside.sinks.state import TableStore
    store = TableStore(spark)
    now = dt.datetime(2024, 3, 5)
    assert jobs.refresh_unless_empty(store, "inv_pl", spark.createDataFrame([(1,)], "k int"), "inv_pl", now).count() == 1
    assert jobs.refresh_unless_empty(store, "inv_pl", spark.createDataFrame([], "k int"), "inv_pl", now) is None
    assert rows(store.current("inv_pl")) == [(1,)]


def test_mail_manifest_one_message_per_zip(spark):
    ready = spark.createDataFrame([("u1", "a;b", "Shared%20Documents/F"), ("u2", "c", "Shared%20Documents/G")],
                                  "unique_item_id string, customer_contact string, folder_path string")
    zips = spark.createDataFrame([("Shared%20Documents/F", "BK1.zip"), ("Shared%20Documents/F", "X.ZIP"),
                                  ("Shared%20Documents/F", "a.pdf"), ("Shared%20Documents/G", "PO2.zip")],
                                 "folder_path string, file_name string")
    out = sorted(rows(jobs.mail_manifest(ready, zips), "unique_item_id", "file_name", "recipients"))
    assert out == [("u1", "BK1.zip", ["a", "b"]), ("u2", "PO2.zip", ["c"])]


def test_cert_list_drops_null_keys(spark):
    cols = list(jobs.CERT_KEYS) + ["sales_organization"]
    base = ["x"] * len(jobs.CERT_KEYS)
    data = [tuple(base + ["MX01"]), tuple(base + ["MX02"]), tuple(base[:-1] + [None] + ["MX03"])]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    assert rows(jobs.cert_list(df), "sales_organization") == [("MX01;MX02",)]


# --- loads as chains: rows -> table -> run log -------------------------------
def _store(spark):
    from quayside.sinks.state import TableStore
    return TableStore(spark)


def test_customer_loads_check_lengths_and_log(spark):
    store = _store(spark)
    n = len(jobs.DOC_COLUMNS)
    row = ["z"] * n
    long_free, long_bad = list(row), list(row)
    long_free[jobs.DOC_COLUMNS.index("note")] = "n" * 300
    long_bad[jobs.DOC_COLUMNS.index("country")] = "c" * 256
    sheet = spark.createDataFrame([tuple(row), tuple(long_free), tuple(long_bad)], ", ".join(f"c{i} string" for i in range(n)))
    table, rejected = jobs.load_customer_docs(store, sheet, NOW)
    assert table.count() == 2 and rows(rejected, "reject_reason") == [("country: longer than 255",)]
    m = len(jobs.FREIGHT_COLUMNS)
    cells = ["f"] * m
    cells[jobs.FREIGHT_COLUMNS.index("SI_comments")] = "s" * 300
    sheet = spark.createDataFrame([tuple(cells)], ", ".join(f"c{i} string" for i in range(m)))
    table, _ = jobs.load_customer_freight(store, sheet, NOW)
    assert len(table.columns) == m + 1 and table.count() == 1
    assert sorted(rows(store.read_appended("run_log"), "target", "status", "rows")) == [
        ("MD_Doc", "Success", 2), ("MD_Doc_Cus_Freights", "Success", 1)]


def test_proforma_load_writes_both_tables(spark):
    store = _store(spark)
    names = list(jobs.PROFORMA_COLUMNS)
    cells = {c: "1" for c in names} | {"Marca": "12.0", "Caja": "k" * 300}
    good = {**cells, "Caja": "k"}
    sheet = spark.createDataFrame([tuple(r[c] for c in names) for r in (cells, good)],
                                  ", ".join(f"`{c}` string" for c in names)).withColumn("Fecha facturacion", F.lit(45000))
    pgi = spark.createDataFrame([("1", "a", "b", "x")], "`Sales Order` string, `MX SKU` string, `ERP SKU` string, other string")
    (table, rejected), (second, _) = jobs.load_proforma(store, sheet, pgi, NOW)
    assert rows(table, "Marca", "Caja") == [("12", "k")] and rejected.count() == 1
    assert second.columns == ["Sales_order_number", "MX_SKU", "ERP_SKU"]
    assert sorted(rows(store.read_appended("run_log"), "target", "rows")) == [("DMS_PGI", 1), ("DMS_Proforma", 1)]


def test_delivery_report_load_replaces_stems_and_logs_files(spark):
    store = _store(spark)
    kinds = {c: "string" for c in jobs.REPORT_ORDER}

    def sheet(*keys):
        cells = [{**dict.fromkeys(jobs.REPORT_ORDER), "SalesDocno.": k, "Number of Pallets": p} for k, p in keys]
        return spark.createDataFrame([tuple(r[c] for c in jobs.REPORT_ORDER) for r in cells],
                                     ", ".join(f"`{c}` {t}" for c, t in kinds.items()))
    files = spark.createDataFrame([("AB1.xlsx", NOW), ("old1.xlsx", NOW - dt.timedelta(days=9))],
                                  "file_name string, modificationTime timestamp_ntz")
    jobs.load_delivery_report(store, sheet(("A1", "1"), ("C1", "2")), files, NOW)
    table, bad = jobs.load_delivery_report(store, sheet(("AB2", "1"), ("AB3", "x")), files.withColumn(
        "file_name", F.replace("file_name", F.lit("AB1"), F.lit("A12"))), NOW)
    assert sorted(rows(table, "SalesDocno")) == [("AB2",), ("C1",)]
    assert rows(bad, "Number of Pallets") == [("x",)]
    assert sorted(rows(store.read_appended("run_log"), "file_name")) == [("A12.xlsx",), ("AB1.xlsx",)]


def test_refresh_report_counts_and_logs(spark):
    import uuid

    from quayside.session import work_dir
    store = _store(spark)
    name = f"rr_{uuid.uuid4().hex[:6]}"
    place = f"{work_dir(spark)}/{name}"
    out = jobs.refresh_report(spark, store, name, place, "SELECT explode(sequence(1, 3)) AS k", "mec", NOW)
    assert out.count() == 3
    assert jobs.refresh_report(spark, store, name, place, "SELECT nothing FROM nowhere", "mec", NOW) is None
    assert sorted(rows(store.read_appended("run_log"), "status", "rows"), key=str) == [
        ("Failed: AnalysisException", None), ("Success", 3)]
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_unlogged_runner_raises_and_writes_no_log(spark):
    store = _store(spark)
    out = jobs.run_stored_texts(spark, store, {"extra": "SELECT 1 AS k"}, "extra", NOW, logged=False)
    assert out["extra"].count() == 1
    with pytest.raises(Exception, match="nowhere"):
        jobs.run_stored_texts(spark, store, {"extra": "SELECT 1 FROM nowhere"}, "extra", NOW, logged=False)
    with pytest.raises(Exception):
        store.read_appended("run_log").count()


def test_booking_lookup_and_load_many(spark):
    h = spark.createDataFrame([("b1", 1.5), ("b2", 2.5)], "booking_number string, w double").selectExpr(
        "booking_number", "CAST(w AS DECIMAL(10,2)) AS w")
    out = jobs.booking_lookup(spark, "SELECT H.* FROM bookings H", "b2", {"bookings": h}, ["w"])
    assert rows(out) == [("b2", 2.5)]
    store = _store(spark)
    good = spark.createDataFrame([("1",)], "k string")
    bad = good.select(F.raise_error(F.lit("no source")).cast("string").alias("k"))
    done = jobs.load_many(store, {"one": (bad, {}), "two": (good, {"k": "int"})}, "erp", NOW)
    assert set(done) == {"two"}
    log = sorted(rows(store.read_appended("run_log"), "target", "rows"))
    assert log == [("one", None), ("two", 1)]


def test_delivery_report_newest_file_wins_and_counts(spark):
    store = _store(spark)

    def sheet(*cells):
        made = [{**dict.fromkeys(jobs.REPORT_ORDER), "SalesDocno.": k, "Number of Pallets": p, "Material": m, "file_name": f}
                for k, p, m, f in cells]
        cols = [*jobs.REPORT_ORDER, "file_name"]
        return spark.createDataFrame([tuple(r[c] for c in cols) for r in made], ", ".join(f"`{c}` string" for c in cols))
    files = spark.createDataFrame([("45a.xlsx", NOW - dt.timedelta(days=2)), ("4501a.xlsx", NOW - dt.timedelta(days=1)),
                                   ("9a.xlsx", NOW)], "file_name string, modificationTime timestamp_ntz")
    table, bad = jobs.load_delivery_report(store, sheet(
        ("4501-1", "1", "old", "45a.xlsx"), ("4502-1", "1", "old", "45a.xlsx"), ("4501-1", "2", "new", "4501a.xlsx"),
        ("4501-2", "x", "bad", "4501a.xlsx")), files, NOW)
    assert sorted(rows(table, "SalesDocno", "Material")) == [("4501-1", "new"), ("4502-1", "old")]
    assert rows(bad, "SalesDocno") == [("4501-2",)]
    log = store.read_appended("run_log")
    assert sorted(rows(log, "file_name", "status", "rows")) == [
        ("4501a.xlsx", "Success", 1), ("45a.xlsx", "Success", 2), ("9a.xlsx", "Success", 0)]
    with pytest.raises(Exception):
        jobs.load_delivery_report(store, sheet(("1", "1", "m", "9a.xlsx")).drop("Invoice"), files, NOW)
    assert rows(store.read_appended("run_log").where("status like 'Failed%'"), "job", "status") == [
        ("delivery_report", "Failed: SchemaMismatch")]
    assert store.current("DMS_Z_XXVL_162").count() == 2


def test_folder_job_runs_whole(spark):
    store = _store(spark)
    cols = ("sales_order_number booking_number po_number shipp_condition shipto_number shipto_name shipto_country region "
            "OTdata status").split()
    row = lambda n, region: (n, "b", "p", "Ocean", "7", "Na.me", "MX", region, f"OT{n}", None)
    df = spark.createDataFrame([row("1", "R"), row("2", "R"), row("3", None)], ", ".join(f"{c} string" for c in cols))
    made = []

    def create(paths):  # the second folder's batch fails
        made.extend(r[0] for r in paths.collect())
        return paths.where("site_path like '%OT1'")

    def split():
        raise RuntimeError("no bookings")
    state = jobs.folder_job(store, df, NOW, create, split)
    assert sorted(rows(state, "sales_order_number", "status")) == [("1", "Done"), ("2", None)]
    assert sorted(made) == [f"Shared%20Documents/R/Shipments/MX/7-Name/Ocean/OT{n}" for n in "12"]
    assert jobs.folder_job(store, df.limit(0), NOW, create) is None
    assert sorted(rows(store.read_appended("run_log"), "target", "status", "rows"), key=str) == sorted([
        ("split_bookings", "Failed: RuntimeError", None), ("folder_paths", "Success", 2), ("folder_paths", "Aborted: no rows", 0)],
        key=str)
    assert store.current("folder_paths").count() == 2


def test_mail_outcome_job_writes_and_logs(spark):
    from quayside.sinks.keyed import KeyedTable
    store = _store(spark)
    queue = KeyedTable(spark, None, ["unique_item_id"], buckets=8)
    queue.create(spark.createDataFrame([(f"m{i}", "Ready", "c", None) for i in range(50)],
                 "unique_item_id string, send_email_status string, send_email_comment string, date_send_email string"))
    out = jobs.mail_outcome_job(queue, store, spark.createDataFrame(
        [("m1", True, None, 1), ("m2", False, "full", 1), ("zz", True, None, 1)],
        "unique_item_id string, ok boolean, error_message string, seq int"), NOW)
    assert out.count() == 50 and sorted(rows(out.where("send_email_status <> 'Ready'"), "unique_item_id", "send_email_status",
                                             "send_email_comment")) == [("m1", "Completed", "c"), ("m2", "Error", "full")]
    assert rows(store.read_appended("run_log"), "job", "rows") == [("mail_outcomes", 3)]


def test_a_report_that_fails_half_way_leaves_the_old_rows(spark):
    import uuid
    from quayside.session import work_dir
    name, loc = f"rep_{uuid.uuid4().hex[:8]}", work_dir(spark, "rep")
    jobs.insert_overwrite(spark, name, loc, "SELECT id AS a FROM range(3)")
    out = jobs.insert_overwrite(spark, name, loc, f"SELECT a + 10 AS a FROM {name}")  # reads itself
    assert sorted(rows(out)) == [(10,), (11,), (12,)]
    with pytest.raises(Exception):
        jobs.insert_overwrite(spark, name, loc, "SELECT CAST(if(id > 900, 'x', '1') AS INT) AS a FROM range(1000)")
    spark.catalog.refreshTable(name)
    assert sorted(rows(spark.table(name))) == [(10,), (11,), (12,)]
    spark.sql(f"DROP TABLE {name}")
