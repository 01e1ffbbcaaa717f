"""The jobs as thin compositions of operators.

Each job takes DataFrames (or a ``TableStore`` holding the tables it
changes), explicit parameters (``now``, modes) and returns DataFrames; side
effects outside the data (mail, uploads, HTTP) are out of scope — jobs stop
at the manifest that would drive them (SURVEY "Not built").
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import strings, values
from quayside.functions.dates import report_date_text, serial_to_date, ts_literal
from quayside.functions.util import col_of
from quayside.operators import aggs, filters, joins, projections, quality, tagging
from quayside.sinks import transitions
from quayside.sinks.keyed import KeyedTable, with_ids
from quayside.sinks.state import TableStore
from quayside.sources.tables import run_stored_sql

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------
ROLLUP_KEYS = ("ShiptoID", "UniqueID")
ROLLUP_COLUMNS = (
    "Bookingnumber", "POnumber", "POL", "Portofdestination", "Vesselname", "CarrierMoveType",
    "Containersloaded", "Containernumber", "Sealnumber", "GrossWeight", "NetWeight",
    "SKU+Description", "Region", "shiptocountry", "ShiptoNumber", "DateDocumentSent", "SISentStatus")
CERT_KEYS = (
    "country", "ShipTo", "Region", "SoldTo", "payer", "shipping", "customer_status", "ID",
    "DocumentName", "DocumentDescription", "Legalization", "LatestDocumentDate", "ExpirationDate",
    "AlertDate", "Status", "Comment")
EXCLUDED_SHIP_TO = 29744324
NOT_FOUND_ZONE = "Not found"
DOC_SHEET = "Documents"
DOC_COLUMNS = (
    "export_zone", "country", "country_code", "sales_organization", "sold_to_number", "sold_to_name",
    "ship_to_number", "ship_to_name", "payer_number", "payer_name", "status", "shipping_conditions",
    "shipping", "prepayment", "kpi", "customer_type", "sending_system", "docs", "bill_of_lading",
    "invoice", "packing_list", "coo", "coa_cat", "coh", "coi", "other_documents",
    "special_requirements", "annual_docs", "hard_copy_docs", "documentation_contact", "dhl_address",
    "tips_tricks", "documentation_owner", "back_up1", "back_up2", "note")
# VARCHAR(MAX); the rest are text(255)
DOC_TEXT_MAX = ("docs", "other_documents", "special_requirements", "annual_docs", "hard_copy_docs",
                "documentation_contact", "dhl_address", "tips_tricks", "note")
FREIGHT_SHEET = "SI&BL"
FREIGHT_COLUMNS = (
    "export_zone", "country", "country_code", "sales_organization", "sold_to_number", "sold_to_name",
    "ship_to_number", "ship_to_name", "payer_number", "payer_name", "status", "shipping", "incoterm",
    "incoterm_2", "door_port", "CNEE", "NTFY_1", "NTFY_2", "consignee_email", "BL_type",
    "BL_instructions", "remarks_BL", "HNumRNum", "BL_receiver", "freight_type", "ocean_payable",
    "precarriage", "origin_port_changes", "sea_freight", "destination_port_changes", "on_carriage",
    "combination", "merge_freights", "SI_template", "buyco_ID", "SI_comments", "Sending_type")
FREIGHT_TEXT_MAX = ("CNEE", "NTFY_1", "NTFY_2", "consignee_email", "BL_instructions", "remarks_BL",
                    "SI_comments")
BAF_POSITION = 29  # BAF is a copy of sea_freight inserted at 0-based position 29
PROFORMA_COLUMNS = {
    "Fecha facturacion": "Fecha_facturacion", "Centro": "Centro",
    "Folio de Referencia": "Folio_de_Referencia", "Folio Fiscal": "Folio_Fiscal",
    "Distribuidor": "Distribuidor", "Marca": "Marca",
    "Descripción del material": "Descripcion_del_material", "Cartones": "Cartones",
    "Importe Neto": "Importe_Neto", "Caja": "Caja", "Sello transporte": "Sello_transporte",
    "Booking": "Booking", "kilos": "kilos", "Peso bruto": "Peso_bruto"}
PROFORMA_TYPES = {"Fecha_facturacion": "date", "Distribuidor": "string",
                  "Descripcion_del_material": "string", "Cartones": "int",
                  "Importe_Neto": "decimal(18,2)", "kilos": "decimal(18,2)", "Peso_bruto": "decimal(18,2)"}
PGI_COLUMNS = {"Sales Order": "Sales_order_number", "MX SKU": "MX_SKU", "ERP SKU": "ERP_SKU"}
REPORT_TEXT = ("SalesDocno.", "Material", "S-PONo", "Sold-to", "Del Blk", "Bill-to", "Ship-to",
               "Invoice", "Cred Blk", "Invoice Currency", "Doc Curr", "Port of loading",
               "Port of Destination")
REPORT_RSTRIP = ("Material", "S-PONo", "Invoice")
REPORT_DOUBLE = ("Qty Delivered", "S-PO-GR-TotQty", "S-PO-IR-TotQty", "Gross Wt From Del.",
                 "Invoice Value", "Gross Value/Order")
REPORT_INT = ("Number of Pallets",)
REPORT_DATES = ("PO Date", "Pr Date in SO", "Billing Date", "Invoice Creation Date", "Ord Cr Date",
                "Cargo Cut off date", "Del Date in SO")
REPORT_ORDER = (
    "SalesDocno.", "Qty Delivered", "Material", "S-PONo", "Sold-to", "Del Blk", "Bill-to", "Ship-to",
    "Invoice", "Cred Blk", "Invoice Currency", "Number of Pallets", "Doc Curr", "Port of loading",
    "Port of Destination", "S-PO-GR-TotQty", "S-PO-IR-TotQty", "Gross Wt From Del.", "PO Date",
    "Pr Date in SO", "Billing Date", "Invoice Creation Date", "Invoice Value", "Ord Cr Date",
    "Cargo Cut off date", "Del Date in SO", "Gross Value/Order")
REPORT_RENAMES = {"SalesDocno.": "SalesDocno", "Gross Wt From Del.": "Gross Wt From Del"}
FILE_LOOKBACK_DAYS = 7
OPTION_STATUSES = ("Active", "Inactive")
PATH_TOKENS = ("Truck", "Ocean")
INVOICE_DEFAULTED = (
    "Date_Created", "Date_Download", "File_Name", "Invoice_Amount", "Invoice_Number",
    "Invoice_Quantity", "PO_Number", "Sales_Organization", "Ship_To_Id", "Delivery", "Material",
    "Output", "Shipment_Number")
SYSLOG_DEFAULTED = ("Sales_Area", "SAP_Shipment", "Error_Message", "TimeStamp")

INVOICE_SCHEMA = T.StructType(
    [T.StructField("Sales_Document", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in INVOICE_DEFAULTED]
    + [T.StructField("pos", T.LongType())])
INVOICE_FIELDS_SCHEMA = T.StructType(INVOICE_SCHEMA.fields[:-1])
SYSLOG_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("Sales_Document",) + SYSLOG_DEFAULTED])


# ---------------------------------------------------------------------------
# Loads and stored-SQL runners
# ---------------------------------------------------------------------------
def load_table(store: TableStore, target: str, rows: DataFrame, types: Mapping[str, str],
               job: str, now: _dt.datetime, max_lengths: Mapping[str, int] | None = None,
               max_records_per_file: int | None = None):
    """Warehouse extract → salvage split (SNK-16) → full refresh (SNK-1;
    files of at most 50,000 rows, SNK-17, where the caller asks for
    ``LOAD_BATCH_ROWS``) → count (AG-7, seen while writing) → run log (SNK-15).
    The extract is read once: rows with their reject reason are staged, and
    both the good and the rejected rows come from the staged files.
    Returns ``(table, rejected)``."""
    staged = store.stage(target, quality.with_reasons(rows, types, max_lengths))
    good, rejected = quality.split_tagged(staged, types)
    table = store.replace(target, good, max_records_per_file=max_records_per_file)
    store.log_run(job, target, "Success", store.rows_of(table), now)
    store.append(f"{target}_rejected", rejected, only_if_rows=True)
    return table, rejected


def load_many(store: TableStore, mapping: Mapping[str, tuple[DataFrame, Mapping[str, str]]],
              job: str, now: _dt.datetime) -> dict[str, DataFrame]:
    """J1–J3 over several tables; one failing table is logged and the rest go on."""
    out = {}
    for target, (rows, types) in mapping.items():
        try:
            out[target], _ = load_table(store, target, rows, types, job, now)
        except Exception as e:  # noqa: BLE001 - logged, the next table still loads
            store.log_run(job, target, f"Failed: {type(e).__name__}", None, now)
    return out


def run_stored_texts(spark: SparkSession, store: TableStore, texts: Mapping[str, str], job: str,
                     now: _dt.datetime, args: Mapping[str, object] | None = None,
                     log_rows: bool = True, logged: bool = True) -> dict[str, DataFrame]:
    """Each stored text builds its target table (CTAS as a new
    version); failures are isolated and logged (SNK-15). ``logged=False`` (J29)
    writes no run log, and then a failure is raised: nothing else would tell."""
    out = {}
    for target, text in texts.items():
        try:
            df = run_stored_sql(spark, text, args)
            out[target] = store.replace(target, df)
            if logged:
                store.log_run(job, target, "Success", store.rows_of(out[target]) if log_rows else 0, now)
        except Exception as e:  # noqa: BLE001
            if not logged:
                raise
            store.log_run(job, target, f"Failed: {type(e).__name__}", None, now)
    return out


def refresh_unless_empty(store: TableStore, target: str, df: DataFrame, job: str,
                         now: _dt.datetime) -> DataFrame | None:
    """Refresh-or-abort (SNK-7 + SNK-1 + SNK-15)."""
    out = store.replace_unless_empty(target, df)
    store.log_run(job, target, "Success" if out is not None else "Aborted: no rows",
                  store.rows_of(out) if out is not None else 0, now)
    return out


def insert_overwrite(spark: SparkSession, table: str, location: str, text: str,
                     args: Mapping[str, object] | None = None) -> DataFrame:
    """J26 / SNK-2: replace a catalog table's rows by a stored query's.

    The rows are written once, to a new folder under ``location``; then the
    table is pointed at it. A query that reads the table sees the old rows, and
    a failure at any point leaves them in place."""
    target = f"{location.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    run_stored_sql(spark, text, args).write.parquet(target)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{target}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def refresh_report(spark: SparkSession, store: TableStore, table: str, location: str, text: str,
                   job: str, now: _dt.datetime) -> DataFrame | None:
    """``INSERT OVERWRITE`` from the stored query, the table's row count and
    a run log row (SNK-15); a failure is logged and leaves the old rows."""
    try:
        out = insert_overwrite(spark, table, location, text)
        store.log_run(job, table, "Success", out.count(), now)
        return out
    except Exception as e:  # noqa: BLE001 - logged; the old rows stay
        store.log_run(job, table, f"Failed: {type(e).__name__}", None, now)
        return None


# ---------------------------------------------------------------------------
# alerts
# ---------------------------------------------------------------------------
def shipment_alerts(store: TableStore, shipments: DataFrame,
                    cols: Sequence[str] = ROLLUP_COLUMNS, compat: bool = False, pieces: int = 1) -> DataFrame:
    """Roll up today's shipments into a new all-text D0 version (the old
    one becomes hist, SNK-5), diff D0 against hist (JN-5) and append the
    changes when there are any (SNK-6). Returns the changes. ``compat``: a null
    in ``Containersloaded`` reads ``nan`` (Q1). ``pieces``: the keys are rolled up
    and compared in so many parts, one after another, so that the exchanges of
    one part are on disk at a time; each part reads ``shipments`` anew, which
    suits rows that lie in files (``TableStore.stage``)."""
    nulls = {"Containersloaded": "nan"} if compat else None
    own = filters.pieces(ROLLUP_KEYS, pieces)
    d0 = filters.non_blank(aggs.distinct_rollup(shipments, ROLLUP_KEYS, cols, null_text=nulls), "UniqueID")
    d0 = store.replace("alert_D0", [projections.all_text(d0).filter(p) for p in own])
    hist = store.previous("alert_D0")
    if hist is None:
        return d0.limit(0).select(*ROLLUP_KEYS, *[F.lit(None).cast("string").alias(c) for c in
                                                 ("ChangedColumn", "OldValue", "NewValue")])
    changes = [joins.snapshot_changes(d0.filter(p), hist.filter(p), ROLLUP_KEYS, cols) for p in own]
    return store.append("alert_changes", changes, only_if_rows=True)


def alert_search(changes: DataFrame, regions=(), statuses=(), countries=(), customers=(),
                 modes=()) -> DataFrame:
    """J5 (returns rows; ``json_records`` renders them)."""
    return filters.alert_search(changes, regions, statuses, countries, customers, modes).select(
        "ShiptoID", "UniqueID", "ChangedColumn", "OldValue", "NewValue", "Status")


def alert_status_update(changes: DataFrame, requests: DataFrame, order_col: str = "seq") -> DataFrame:
    """J6 / SNK-10."""
    return transitions.keyed_update(changes, requests, ["ShiptoID", "UniqueID", "ChangedColumn"],
                                    {"Status": "Status"}, order_col)


def _logged(store: TableStore, job: str, target: str, now: _dt.datetime, write: Callable[[], tuple[DataFrame, int]]) -> DataFrame:
    """Run a write and log it (SNK-15); a failure is logged and raised: the table
    has its old rows, and a caller that waits for an answer must hear of it."""
    try:
        table, rows = write()
    except Exception as e:
        store.log_run(job, target, f"Failed: {type(e).__name__}", None, now)
        raise
    store.log_run(job, target, "Success", rows, now)
    return table


def alert_status_job(alerts: KeyedTable, store: TableStore, requests: DataFrame, now: _dt.datetime,
                     order_col: str = "seq") -> DataFrame:
    """J6 as a write: SNK-10 on the partitions that hold requested alerts, and a
    log row with the number of requests. ``alerts`` is keyed on any of the three
    key columns."""
    def write():
        return alerts.change(requests, lambda old, r: alert_status_update(old, r, order_col)), alerts.taken
    return _logged(store, "alert_status_update", "DMS_alert_changes", now, write)


def cert_alerts(certs: DataFrame) -> DataFrame:
    """J7 / FLT-8."""
    return filters.drop_value_keep_null(certs, "Status", "Completed")


def booking_lookup(spark: SparkSession, text: str, booking, views: Mapping[str, DataFrame],
                   decimal_cols: Sequence[str] = ()) -> DataFrame:
    """Stored text + ``WHERE H.booking_number = :booking`` (FLT-9), decimals → double."""
    df = run_stored_sql(spark, text + " WHERE H.booking_number = :booking", {"booking": booking}, views)
    return df.select(*[values.decimal_to_double(c).alias(c) if c in decimal_cols else col_of(c)
                       for c in df.columns])


def json_records(df: DataFrame, out: str = "json") -> DataFrame:
    """SNK-18 / SCL-J1: one JSON object per row, null fields kept."""
    return df.select(values.row_json(*df.columns).alias(out))


# ---------------------------------------------------------------------------
# Preview of a shared table
# ---------------------------------------------------------------------------
def share_preview(spark: SparkSession, table: str, column: str, n: int,
                  order_by: Sequence[str] | None = None) -> DataFrame:
    """SRC-8 + LIM-1: the first ``n`` values of one column."""
    return projections.first_n(spark.table(table).select(col_of(column), *(order_by or [])), n, order_by) \
        .select(col_of(column))


# ---------------------------------------------------------------------------
# Workbook loads
# ---------------------------------------------------------------------------
def customer_docs(sheet: DataFrame) -> DataFrame:
    """J11 body: FLT-1, FLT-2 (with AG-8), PRJ-1, PRJ-5 on the "Documents" sheet
    (36 columns by position; ship-to is the 7th, export zone the 1st)."""
    src_cols = sheet.columns
    if len(src_cols) != len(DOC_COLUMNS):
        raise projections.SchemaMismatch(f"expected {len(DOC_COLUMNS)} columns, got {len(src_cols)}")
    kept = filters.drop_value_keep_null(sheet, src_cols[6], EXCLUDED_SHIP_TO)
    kept = filters.drop_containing_if_any(kept, src_cols[0], NOT_FOUND_ZONE)
    renamed = projections.rename_by_position(kept, DOC_COLUMNS)
    return projections.cast_to_types(renamed, {}, "string")


def customer_freight(sheet: DataFrame) -> DataFrame:
    """J12 body: PRJ-1 (37 names), PRJ-3 (BAF = sea_freight at 29), SCL-S11 on every column, PRJ-5."""
    renamed = projections.rename_by_position(sheet, FREIGHT_COLUMNS)
    with_baf = projections.insert_copy(renamed, "sea_freight", "BAF", BAF_POSITION)
    text = with_baf.select(*[strings.newline_to_space(col_of(c).cast("string")).alias(c)
                             for c in with_baf.columns])
    return text


def text_limits(columns: Iterable[str], unlimited: Sequence[str], n: int = 255) -> dict[str, int]:
    """PRJ-5: the longest text of each column that is not unlimited."""
    return {c: n for c in columns if c not in unlimited}


def load_customer_docs(store: TableStore, sheet: DataFrame, now: _dt.datetime):
    """The "Documents" rows as the typed table, with the run log; rows with
    a text beyond its column's 255 characters go to ``MD_Doc_rejected``."""
    return load_table(store, "MD_Doc", customer_docs(sheet), {}, "customer_docs", now,
                      text_limits(DOC_COLUMNS, DOC_TEXT_MAX))


def load_customer_freight(store: TableStore, sheet: DataFrame, now: _dt.datetime):
    """The "SI&BL" rows (38 columns with BAF) as the typed table, with the run log."""
    rows = customer_freight(sheet)
    return load_table(store, "MD_Doc_Cus_Freights", rows, {}, "customer_freight", now,
                      text_limits(rows.columns, FREIGHT_TEXT_MAX))


def load_proforma(store: TableStore, sheet: DataFrame, pgi_sheet: DataFrame, now: _dt.datetime,
                  mode: str = "exact"):
    """Both sheets as typed tables with a run log row each. Returns
    ``(proforma, pgi)``, each as ``(table, rejected)``."""
    untyped = [c for c in PROFORMA_COLUMNS.values() if c not in PROFORMA_TYPES]
    first = load_table(store, "DMS_Proforma", proforma(sheet, mode), {}, "proforma", now, text_limits(untyped, ()))
    second = load_table(store, "DMS_PGI", pgi(pgi_sheet), {}, "proforma", now, text_limits(PGI_COLUMNS.values(), ()))
    return first, second


def load_delivery_report(store: TableStore, sheet: DataFrame, files: DataFrame, now: _dt.datetime,
                         mode: str = "exact", target: str = "DMS_Z_XXVL_162"):
    """The week's files → quarantine (SNK-16) → rows of their stems replaced
    (SNK-9; of overlapping files the newest wins, Q18) → one run log row per file
    with its rows (SNK-15). ``files``: ``file_name``, ``modificationTime``;
    ``sheet``: the rows with their ``file_name`` (a sheet without it is the rows
    of all files at once, then none replaces another's). The sheet is read once.
    A failure leaves the table as it was and is logged. Returns ``(table,
    quarantine)``."""
    try:
        stems = store.stage(f"{target}_files", report_file_stems(files, now))
        by_file = "file_name" in sheet.columns
        raw = store.stage(target, sheet)
        tagged, bad = delivery_report(raw, mode, keep=("file_name",) if by_file else ())
        order = "modificationTime" if by_file else None
        if by_file:
            tagged = tagged.join(stems.select("file_name", "modificationTime"), "file_name")
        good = store.stage(target, tagged)
        rows = good.drop("file_name", "modificationTime") if by_file else good
        old = store.current(target)
        table = store.replace(target, delivery_report_state(
            rows.limit(0) if old is None else old, good.drop("file_name") if by_file else good, stems, order_col=order))
        store.append(f"{target}_rejected", bad, only_if_rows=True)
        counted = stems.select("file_name").withColumn("rows", F.lit(None).cast("long"))
        if by_file:
            n = good.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))
            counted = stems.select("file_name").join(n, "file_name", "left").select(
                "file_name", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
        store.append("run_log", counted.select(
            F.lit("delivery_report").alias("job"), F.lit(target).alias("target"), "file_name",
            F.lit("Success").alias("status"), "rows", ts_literal(now).alias("logged_at")))
        return table, bad
    except Exception as e:
        store.log_run("delivery_report", target, f"Failed: {type(e).__name__}", None, now)
        raise


def proforma(sheet: DataFrame, mode: str = "exact") -> DataFrame:
    """J13 body: SCL-D1 (serial → date), SCL-S10 on ``Marca``, PRJ-2, PRJ-5."""
    fixed = sheet.withColumn("Fecha facturacion", serial_to_date("Fecha facturacion"))
    marca = col_of("Marca").cast("string")
    fixed = fixed.withColumn("Marca", strings.remove_all(marca, ".0") if mode == "compat"
                             else strings.strip_point_zero(marca))
    picked = projections.select_renamed(fixed, PROFORMA_COLUMNS)
    return projections.cast_to_types(picked, PROFORMA_TYPES, "string")


def pgi(sheet: DataFrame) -> DataFrame:
    """J13 body, second sheet."""
    return projections.cast_to_types(projections.select_renamed(sheet, PGI_COLUMNS), {}, "string")


def delivery_report(sheet: DataFrame, mode: str = "exact", strict: bool = False, keep: Sequence[str] = ()):
    """J14 body: SCL-N1 casts, SCL-S9, SCL-D2, PRJ-2 (27 columns by name),
    SCL-L2. ``mode='compat'`` reproduces the text quirks (``'100'`` → ``'1'``,
    missing text → ``'nan'`` → ``''``); ``exact`` keeps ids and nulls.
    Returns ``(rows, quarantine)``: a row whose number cell does not parse goes
    to quarantine (Q4) with its raw cells as text and a reason, unless
    ``strict`` raises instead. ``keep``: further columns to carry along."""
    missing = [c for c in REPORT_ORDER if c not in sheet.columns]
    if missing:
        raise projections.SchemaMismatch(f"missing columns: {missing}")
    cells = {}
    for c in REPORT_TEXT:
        txt = col_of(c).cast("string")
        if mode == "compat":
            txt = F.coalesce(txt, F.lit("nan"))
            if c in REPORT_RSTRIP:
                txt = strings.rstrip_chars(txt, ".0")
        elif c in REPORT_RSTRIP:
            txt = strings.strip_point_zero(txt)
        cells[c] = txt
    typed = {}
    for c in REPORT_DOUBLE:
        typed[c] = ("double", col_of(c))
    for c in REPORT_INT:
        typed[c] = ("int", col_of(c))
    for c in REPORT_DATES:
        cells[c] = report_date_text(c)
    reasons = []
    for c, (t, expr) in typed.items():
        v = expr.try_cast("double")
        v = v.try_cast("int") if t == "int" else v  # a number beyond int is no pallet count
        bad = v.isNull() if t == "int" else (expr.isNotNull() & v.isNull())
        reasons.append(F.when(bad, F.lit(f"{c}: not {t}")))
        cells[c] = v
    tagged = sheet.withColumn(quality.REASON, F.concat_ws("; ", *reasons))
    name = lambda c: REPORT_RENAMES.get(c, c)
    good = tagged.filter(F.col(quality.REASON) == "").select(
        *[cells[c].alias(name(c)) for c in REPORT_ORDER], *[col_of(c) for c in keep])
    if mode == "compat":
        good = values.nan_text_to_empty(good, [name(c) for c in REPORT_TEXT])
    bad = tagged.filter(F.col(quality.REASON) != "").select(
        *[col_of(c).cast("string").alias(name(c)) for c in REPORT_ORDER], *[col_of(c) for c in keep], quality.REASON)
    if strict and not bad.isEmpty():
        raise ValueError("delivery report has cells that do not parse")
    return good, bad


def report_file_stems(files: DataFrame, now: _dt.datetime, name_col: str = "file_name") -> DataFrame:
    """J14 discovery: exact-case ``.xlsx`` files modified in ``[now-7d, now]``;
    the stem drops the last six characters (SCL-S8)."""
    from quayside.functions.dates import within_days_before
    picked = files.filter(col_of(name_col).endswith(".xlsx")
                          & within_days_before("modificationTime", now, FILE_LOOKBACK_DAYS))
    return picked.withColumn("stem", strings.drop_last_chars(name_col, 6))


def delivery_report_state(old: DataFrame, new_rows: DataFrame, stems: DataFrame,
                          key_col: str = "SalesDocno", order_col: str | None = None) -> DataFrame:
    """J14 state: delete by every stem from the *old* state, append the new rows
    (Q18); with ``order_col`` the newest of overlapping files wins. A file
    without a stem replaces nothing (``joins.empty_stems`` lists such files)."""
    return transitions.prefix_replace(old, new_rows, stems, key_col, "stem", order_col)


# ---------------------------------------------------------------------------
# Folders, routing, bundles
# ---------------------------------------------------------------------------
FOLDER_COLUMNS = ("sales_order_number", "booking_number", "po_number", "shipp_condition",
                  "shipto_number", "shipto_name", "shipto_country", "region", "folder_path", "status")


def folder_paths(rows: DataFrame) -> DataFrame:
    """J15 body: SCL-S1 on country, name and OT data; the path (SCL-S2, null if
    any part is null); FLT-4; PRJ-4 (OTdata dropped); PRJ-2 (10 columns).

    FLT-4 is applied to the path's parts: ``a + b + …`` is null exactly when
    a part is null, so "path not null" is "no part null" — a cheap test that
    runs before the text work (a filter on the path itself would be pushed
    below the projection and compute every strip twice)."""
    parts = ("region", "shipto_country", "shipto_number", "shipto_name", "shipp_condition", "OTdata")
    kept = rows
    for p in parts:
        kept = filters.not_null(kept, p)
    clean = kept.select(*[strings.strip_special(c).alias(c) if c in ("shipto_country", "shipto_name", "OTdata")
                          else col_of(c) for c in kept.columns])
    path = strings.plus_concat("region", F.lit("/Shipments/"), "shipto_country", F.lit("/"),
                               "shipto_number", F.lit("-"), "shipto_name", F.lit("/"),
                               "shipp_condition", F.lit("/"), "OTdata")
    out = clean.withColumn("folder_path", path).drop("OTdata")
    return projections.select_renamed(out, [(c, c) for c in FOLDER_COLUMNS])


def folder_state(store: TableStore, new_rows: DataFrame) -> DataFrame | None:
    """J15 state: abort on an empty result (SNK-7), else drop rows with a null
    status and append (SNK-8) as the next version. The new rows are staged
    once, so the emptiness check and the transition read files."""
    staged = store.stage("folder_paths", new_rows)
    if not store.rows_of(staged):
        return None
    old = store.current("folder_paths")
    nxt = staged if old is None else transitions.partial_replace(old, staged)
    return store.replace("folder_paths", nxt)


def folders_to_create(state: DataFrame) -> DataFrame:
    """Distinct site paths still to create (AG-4, SCL-S13)."""
    pending = state.filter(F.col("status").isNull())
    return aggs.distinct_values(pending.select(strings.with_site_root("folder_path").alias("site_path")),
                                "site_path")


def folders_done(state: DataFrame, created_site_paths: DataFrame) -> DataFrame:
    """J15 write-back (SNK-12): the site paths that were created → ``Done``."""
    done = created_site_paths.select(strings.without_site_root("site_path").alias("folder_path"))
    return transitions.mark_done(state, done)


def folder_job(store: TableStore, rows: DataFrame, now: _dt.datetime, create: Callable[[DataFrame], DataFrame],
               split_bookings: Callable[[], object] | None = None) -> DataFrame | None:
    """J15 whole: the stored split-bookings statement (a failure is logged and
    the job goes on), the folder table's next version (SNK-7, SNK-8), its log
    row with the number of uploaded rows (SNK-15), then the folders: ``create``
    gets the site paths to make and returns those it made (Q17: a batch that
    fails half-way returns what it had), and only those become ``Done`` (SNK-12).
    An empty result is logged and leaves the table alone."""
    if split_bookings is not None:
        try:
            split_bookings()
        except Exception as e:  # noqa: BLE001 - logged, the folders are made all the same
            store.log_run("folder_paths", "split_bookings", f"Failed: {type(e).__name__}", None, now)
    new = store.stage("folder_paths", folder_paths(rows))
    state = folder_state(store, new)
    if state is None:
        store.log_run("folder_paths", "folder_paths", "Aborted: no rows", 0, now)
        return None
    store.log_run("folder_paths", "folder_paths", "Success", store.rows_of(new), now)
    return store.replace("folder_paths", folders_done(state, create(folders_to_create(state))))


def file_routing(blobs: DataFrame, invoices: DataFrame, folders: DataFrame, today: _dt.date) -> DataFrame:
    """Each ``.pdf`` blob (any case) → its dated test folder, plus every
    distinct non-null folder of the invoices whose file name starts with the
    blob's stem (JN-4, literal prefix), joined to folders on the leading-zero
    rule (JN-2, SCL-S12). Blobs without a folder are ``unrouted`` (Q10); a blob
    whose stem is empty (``.pdf``) would match every invoice and is routed to
    ``quarantine`` instead.
    The case-blind ``.pdf`` test is SCL-S16 (``lower`` + ``endswith`` built-ins).
    Output: ``name, route, target``."""
    pdf = blobs.filter(F.lower("name").endswith(".pdf")).select(
        "name", strings.base_name("name").alias("file"), strings.pdf_stem("name").alias("stem"))
    # folders are looked up once an invoice, not once a prefix of its name, and
    # equal targets of a stem are put together before the blobs' names come in
    routed = joins.computed_key_left(invoices.select("file_name", "Sales_Document"),
                                     strings.leading_zero_key("Sales_Document"),
                                     folders.select("sales_order_number", "folder_path"), "sales_order_number")
    routed = routed.filter(F.col("folder_path").isNotNull()).select("file_name", "folder_path")
    targets = joins.prefix_join(routed, "file_name", pdf.select("stem").distinct(), "stem").select("stem", "folder_path").distinct()
    to_folder = pdf.distinct().join(targets, "stem").select(
        "name", "file", F.lit("folder").alias("route"), F.col("folder_path").alias("target"))
    dated = pdf.select("name", "file", F.lit("dated").alias("route"),
                       strings.dated_folder(F.lit(today).cast("date")).alias("target"))
    route = F.when(F.length("stem") > 0, "unrouted").otherwise("quarantine")
    unrouted = (pdf.join(targets.select("stem").distinct(), "stem", "left_anti")
                .select("name", "file", route.alias("route"), F.lit(None).cast("string").alias("target")))
    return dated.unionByName(to_folder).unionByName(unrouted)


def zip_bundles(tickets: DataFrame, mails: DataFrame, lookup: DataFrame, listing: DataFrame) -> DataFrame:
    """Ready folders from both queues (JN-1, FLT-12, SET-1, AG-4); folders
    whose listing has a PDF and no ZIP (FLT-13); one bundle per path token
    found (SCL-S6) with the folder's sorted PDF names (AG-9).
    Output: ``folder_path, zip_name, pdf_names``."""
    cols = ["sales_order_number", "booking_number", "customer_purchase_order_number", "shipping", "folder_path"]
    t = filters.status_in(joins.lookup_left(tickets, lookup, "shipping_conditions", "shipping_condition"),
                          "ticket_upload_status", ["Ready"]).select(*cols)
    m = filters.status_in(joins.lookup_left(mails, lookup, "shipping_conditions", "shipping_condition"),
                          "send_email_status", ["Ready"]).select(*cols)
    ready = aggs.distinct_values(projections.union_distinct(t, m), "folder_path")
    name = F.lower("file_name")
    per_folder = (listing.join(ready, "folder_path", "left_semi")
                  .groupBy("folder_path")
                  .agg(F.bool_or(name.endswith(".pdf")).alias("has_pdf"),
                       F.bool_or(name.endswith(".zip")).alias("has_zip"),
                       F.sort_array(F.collect_list(F.when(name.endswith(".pdf"), F.col("file_name"))))
                       .alias("pdf_names")))
    todo = per_folder.filter(F.col("has_pdf") & ~F.col("has_zip"))
    tokens = F.array(*[strings.path_token_after("folder_path", tok) for tok in PATH_TOKENS])
    return (todo.select("folder_path", "pdf_names", F.explode(tokens).alias("token"))
            .filter(F.col("token").isNotNull())
            .select("folder_path", F.concat("token", F.lit(".zip")).alias("zip_name"), "pdf_names"))


# ---------------------------------------------------------------------------
# mail
# ---------------------------------------------------------------------------
def mail_ready(queue: DataFrame, shipping_lookup: DataFrame) -> DataFrame:
    """J18 selector: JN-1, FLT-5, SCL-C1, SCL-S4, SCL-S3, AG-3."""
    j = joins.lookup_left(queue, shipping_lookup, "shipping_conditions", "shipping_condition")
    ready = filters.ready_with_contact(j)
    return ready.select(
        "sales_order_number", "unique_item_id",
        values.shipping_label("shipping").alias("Booking/PO_name"),
        "export_zone_flow", "shipping", "subject", "documentation_agent",
        strings.clean_contacts("customer_contact").alias("customer_contact"),
        strings.with_site_root("folder_path").alias("folder_path"),
        "send_email_comment").distinct()


def mail_manifest(ready: DataFrame, zips: DataFrame) -> DataFrame:
    """One message per ready row × exact-case ``.zip`` file of its folder,
    with its recipients (SCL-S5). ``zips``: ``folder_path`` (site path), ``file_name``."""
    z = zips.filter(F.col("file_name").endswith(".zip"))
    return (ready.join(z, "folder_path")
            .withColumn("recipients", strings.split_recipients("customer_contact")))


def mail_outcomes(queue: DataFrame, outcomes: DataFrame, now: _dt.datetime) -> DataFrame:
    """J19 / SNK-13."""
    return transitions.mail_outcomes(queue, outcomes, now)


def mail_outcome_job(queue: KeyedTable, store: TableStore, outcomes: DataFrame, now: _dt.datetime) -> DataFrame:
    """J19 as a write: SNK-13 on the partitions that hold sent items, and a log row."""
    def write():
        return queue.change(outcomes, lambda old, o: mail_outcomes(old, o, now)), queue.taken
    return _logged(store, "mail_outcomes", "DMS_Automatic_Email", now, write)


# ---------------------------------------------------------------------------
# certificates
# ---------------------------------------------------------------------------
def cert_list(rows: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """J20 / AG-2."""
    return aggs.ordered_concat(rows, CERT_KEYS, "sales_organization", order_by)


def cert_update(table: DataFrame, requests: DataFrame, order_col: str = "seq") -> DataFrame:
    """J21 / SNK-11 (then J20 on the new version); requests are applied in the
    order of ``order_col``."""
    return transitions.cert_update(table, requests, order_col=order_col)


def cert_insert(table: DataFrame, requests: DataFrame) -> DataFrame:
    """J22 / SNK-14."""
    return transitions.cert_insert(table, requests)


def cert_insert_job(certs: KeyedTable, store: TableStore, requests: DataFrame, now: _dt.datetime,
                    order_col: str = "seq") -> DataFrame:
    """J22 as a write: SNK-14 with ids that follow the table's greatest, in the
    order of ``order_col``; files are added, none is rewritten; a log row."""
    def write():
        rows = with_ids(transitions.cert_rows(requests, [order_col]), certs.highest("ID") + 1, [order_col])
        return certs.insert(rows.drop(order_col)), certs.taken
    return _logged(store, "cert_insert", "DMS_Yearly_Cert", now, write)


def cert_table_update(certs: KeyedTable, store: TableStore, requests: DataFrame, now: _dt.datetime,
                      order_col: str = "seq") -> DataFrame:
    """The write of J21: SNK-11 on the partitions that hold requested ids, and a log row."""
    def write():
        return certs.change(requests, lambda old, r: cert_update(old, r, order_col)), certs.taken
    return _logged(store, "cert_update", "DMS_Yearly_Cert", now, write)


def cert_update_job(certs: KeyedTable, store: TableStore, requests: DataFrame, now: _dt.datetime,
                    listed: Callable[[DataFrame], DataFrame], order_col: str = "seq",
                    list_order: Sequence[str] | None = None) -> DataFrame:
    """J21 whole: the table's update, then the certificate list (J20) of the
    updated table; ``listed`` is the stored query that gives the list's rows."""
    return cert_list(listed(cert_table_update(certs, store, requests, now, order_col)), list_order)


# ---------------------------------------------------------------------------
# Ingest with duplicate tags
# ---------------------------------------------------------------------------
def tag_posted_invoices(lines: DataFrame, batch_ts: _dt.datetime):
    """J23 on posted objects (post, pos, raw): fields from the JSON text, tags
    per post. Returns ``(tagged, quarantine)``."""
    j = lines.select("post", "pos", "raw", F.from_json("raw", INVOICE_FIELDS_SCHEMA).alias("__j"))
    rows = j.select("post", "pos", "raw", "__j.*")
    tagged, bad = tag_invoices(rows, batch_ts, "post")
    return tagged, bad.select("post", "pos", "raw")


def tag_invoices(rows: DataFrame, batch_ts: _dt.datetime, batch_col: str | None = None):
    """SRC-6 defaults (absent fields → null, SCL-L3), WN-1, WN-3. Returns
    ``(tagged, quarantine)``; quarantine = the rows without a document (Q19)."""
    for c in INVOICE_DEFAULTED:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    good = rows.filter(F.col("Sales_Document").isNotNull())
    quarantine = rows.filter(F.col("Sales_Document").isNull())
    tagged = tagging.dup_tags(good, "Sales_Document", "pos", batch_col)
    cols = (["pos"] + ([batch_col] if batch_col else []) + ["Sales_Document", *INVOICE_DEFAULTED])
    return tagged.select(*cols, "Dup_Value",
                         tagging.unique_value("Sales_Document", batch_ts).alias("UniqueValue")), quarantine


def tag_syslog_lines(lines: DataFrame, batch_ts: _dt.datetime, raw_col: str = "raw",
                     batch_col: str | None = None):
    """Raw JSON lines → fields (SRC-6), id by key presence (WN-2), WN-1,
    WN-3. Returns ``(tagged, quarantine)``; quarantine = lines without an id."""
    parsed = lines.select("*", F.from_json(raw_col, SYSLOG_SCHEMA).alias("__j"),
                          tagging.syslog_id(raw_col).alias("log_id"))
    fields = [F.col(f"__j.{c}").alias(c) for c in SYSLOG_DEFAULTED]
    keep = ["pos"] + ([batch_col] if batch_col else [])
    good = parsed.filter(F.col("log_id").isNotNull()).select(*keep, "log_id", *fields)
    quarantine = parsed.filter(F.col("log_id").isNull()).select(*keep, raw_col)
    tagged = tagging.dup_tags(good, "log_id", "pos", batch_col)
    out = tagged.select(*keep, "log_id", *SYSLOG_DEFAULTED, "Dup_Value",
                        tagging.unique_value("log_id", batch_ts).alias("UniqueValue"))
    return out, quarantine


# ---------------------------------------------------------------------------
# Drop-down lists
# ---------------------------------------------------------------------------
def destination_options(customers: DataFrame, codes: DataFrame) -> DataFrame:
    """JN-3, FLT-10, AG-3, SRT-2, SCL-S15, SCL-J2 → ``value, label, option``."""
    j = filters.status_in(joins.codes_inner(customers, codes, "ship_to_country", "alpha_2code"),
                          "customer_status", OPTION_STATUSES)
    names = j.select("country_name").distinct().orderBy("country_name")
    value = strings.remove_double_slash("country_name")
    return names.select(value.alias("value"), value.alias("label"), values.option_json(value, value).alias("option"))


def shipto_options(customers: DataFrame, codes: DataFrame) -> DataFrame:
    """JN-3, FLT-10, AG-6 (on the stored values, before the edits), SCL-S2
    (null name → no option, Q8), SCL-S15, SRT-2 → one row per option,
    ``country, value, label``, ordered by country, stored value descending.
    However many customers a country has, no task holds them all.

    A customer is listed under every name of its code, so few customers can be
    many options: equal customers are put together first and dealt over all
    shuffle partitions, then paired with the names. The options are dealt once, by
    range; that brings equal ones together and orders them. Both numbers of parts
    are given, so that no few tasks get what looks small before it is paired."""
    listed = filters.status_in(customers, "customer_status", OPTION_STATUSES)
    v = strings.plus_concat("ship_to_name", F.lit("-"), "ship_to")
    listed = listed.select("ship_to_country", v.alias("stored")).filter(F.col("stored").isNotNull()).distinct()
    parts = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = codes.select("alpha_2code", "country_name").distinct()
    j = joins.codes_inner(listed.repartition(parts, "stored"), names, "ship_to_country", "alpha_2code")
    order = ["country", F.desc("stored")]
    opts = (j.select(F.col("country_name").alias("country"), "stored")
            .repartitionByRange(parts, *order).distinct().orderBy(*order))
    text = strings.option_text("stored")
    return opts.select("country", text.alias("value"), text.alias("label"))


def nested_options_json(options: DataFrame) -> DataFrame:
    """AG-5 + SNK-18: the options of each country as one JSON array, values
    descending: the last rendering for a front end (one cell per country)."""
    nested = aggs.nested_options(options, "country", "value", "label")
    return nested.select("country", F.to_json("options").alias("options"))
