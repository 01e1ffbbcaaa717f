"""Next-state functions: version *n* (+ inputs) → version *n+1*.

Each is a pure DataFrame expression; ``TableStore.replace`` persists the
result. Update inputs (changes, outcomes, processed paths) are joined on the
table's key; which side is broadcast is left to Spark's sizes. Requests that
repeat a key are applied in turn: the last one by a sequence column wins.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import MAIL_DATE_FORMAT, iso_date_or_null, ts_literal
from quayside.functions.util import col_of, quote
from quayside.operators.joins import prefix_join


def _latest_per_key(changes: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Deduplicate update requests: the last one per key wins (by ``order_col``;
    equal sequence numbers are settled by the other columns' text).

    ``max_by`` is a grouped aggregate with a map-side partial step, so a key
    with very many requests is reduced before the shuffle (a window would sort
    all of that key's requests in one task)."""
    others = [c for c in changes.columns if c not in keys]
    latest = (changes.groupBy(*[quote(k) for k in keys])
              .agg(F.max_by(F.struct(*[col_of(c) for c in others]),
                            F.struct(col_of(order_col), F.to_json(F.struct(*[col_of(c) for c in others])))).alias("__last")))
    return latest.select(*[col_of(k) for k in keys], *[F.col(f"__last.{quote(c)}").alias(c) for c in others])


def keyed_update(table: DataFrame, changes: DataFrame, keys: Sequence[str],
                 set_cols: Mapping[str, object], order_col: str) -> DataFrame:
    """SNK-10 / SNK-11: ``UPDATE table SET col = expr WHERE key = change.key``.

    ``set_cols`` maps a table column to a change column name or a Column over
    the change row. Keys repeated in ``changes`` are deduplicated first (last
    by ``order_col`` wins). Rows without a match keep every value."""
    latest = _latest_per_key(changes, keys, order_col)
    ch = latest.select(
        *[col_of(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[(col_of(v) if isinstance(v, str) else v).alias(f"__v_{c}") for c, v in set_cols.items()],
        F.lit(True).alias("__hit"))
    cond = [col_of(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    j = table.join(ch, cond, "left")
    return j.select(*[
        (F.when(F.col("__hit"), F.col(f"__v_{c}")).otherwise(col_of(c)).cast(table.schema[c].dataType).alias(c)
         if c in set_cols else col_of(c)) for c in table.columns])


def cert_update(table: DataFrame, changes: DataFrame, key: str = "ID",
                text_cols=("DocumentName", "DocumentDescription", "Legalization", "Status", "Comment"),
                date_cols=("LatestDocumentDate", "ExpirationDate", "AlertDate"),
                order_col: str = "seq") -> DataFrame:
    """SNK-11: eight columns by ``ID``; dates through SCL-D3 (null/'' → null)."""
    set_cols = {c: c for c in text_cols}
    set_cols.update({c: iso_date_or_null(F.col(c)) for c in date_cols})
    return keyed_update(table, changes, [key], set_cols, order_col)


def partial_replace(old: DataFrame, new: DataFrame, status_col: str = "status") -> DataFrame:
    """SNK-8: delete rows whose status is null, append the new rows."""
    return old.filter(col_of(status_col).isNotNull()).unionByName(new)


def prefix_replace(old: DataFrame, new: DataFrame, stems: DataFrame, key_col: str,
                   stem_col: str = "stem", order_col: str | None = None) -> DataFrame:
    """SNK-9 (+ JN-6): drop old rows whose key starts with any stem, then
    append the new rows (set-wise, Q18).

    With ``order_col`` (the files' order, in ``stems`` and in ``new``; it is not
    returned) files are applied in turn: a new row whose key starts with the
    stem of a later file is replaced by that file."""
    kept = prefix_join(old, key_col, stems, stem_col, "left_anti")
    if order_col is None:
        return kept.unionByName(new)
    files = stems.select(col_of(stem_col).alias("__stem"), col_of(order_col).alias("__file"))
    keys = new.select(col_of(key_col).alias("__key")).distinct()
    last = prefix_join(keys, "__key", files, "__stem").groupBy("__key").agg(F.max("__file").alias("__last"))
    newest = (new.join(last, col_of(key_col) == F.col("__key"), "left")
              .filter(col_of(order_col) >= F.coalesce("__last", col_of(order_col)))
              .drop("__key", "__last", order_col))
    return kept.unionByName(newest)


def mark_done(table: DataFrame, done_paths: DataFrame, path_col: str = "folder_path",
              status_col: str = "status", done: str = "Done") -> DataFrame:
    """SNK-12: ``status = 'Done'`` for rows whose path was processed."""
    paths = done_paths.select(col_of(path_col).alias("__p"), F.lit(True).alias("__hit")).distinct()
    j = table.join(paths, col_of(path_col) == F.col("__p"), "left")
    return j.select(*[
        (F.when(F.col("__hit"), F.lit(done)).otherwise(col_of(c)).alias(c) if c == status_col else col_of(c))
        for c in table.columns])


def mail_outcomes(table: DataFrame, outcomes: DataFrame, now: _dt.datetime,
                  key: str = "unique_item_id", order_col: str = "seq") -> DataFrame:
    """SNK-13: success → ``Completed`` (comment kept), failure → ``Error`` and
    its message; both set ``date_send_email`` to ``dd/MM/yyyy`` of ``now``.
    ``outcomes``: ``unique_item_id``, ``ok`` boolean, ``error_message`` and a
    sequence column; of several outcomes of one item the last counts.
    The message is a value, never SQL text, so quotes round-trip (Q11)."""
    today = F.date_format(ts_literal(now), MAIL_DATE_FORMAT)
    last = _latest_per_key(outcomes.select(col_of(key), "ok", "error_message", col_of(order_col)), [key], order_col)
    o = last.select(col_of(key).alias("__k"), F.col("ok").alias("__ok"),
                        F.col("error_message").alias("__msg"), F.lit(True).alias("__hit"))
    j = table.join(o, col_of(key) == F.col("__k"), "left")
    hit, failed = F.col("__hit").eqNullSafe(True), F.col("__hit").eqNullSafe(True) & ~F.col("__ok")
    new_vals = {
        "send_email_status": F.when(hit, F.when(F.col("__ok"), F.lit("Completed")).otherwise(F.lit("Error"))),
        "send_email_comment": F.when(failed, F.col("__msg")),
        "date_send_email": F.when(hit, today),
    }
    keep_unless = {"send_email_status": hit, "send_email_comment": failed, "date_send_email": hit}
    return j.select(*[
        F.when(keep_unless[c], new_vals[c]).otherwise(col_of(c)).alias(c) if c in new_vals else col_of(c)
        for c in table.columns])


# Request keys of a certificate insert → stored columns (SNK-14),
# including the request's own spellings.
CERT_INSERT_KEYS = {
    "Country": "Country", "ShipToID": "ShipTo", "DocumentName": "DocumentName",
    "DOcumentDescrption": "DocumentDescription", "Legalization": "Legalization",
    "LastDocumentDate": "LatestDocumentDate", "ExpirationDate": "ExpirationDate",
    "AlertDate": "AlertDate", "Status": "Status", "Comment": "Comment",
}
CERT_DATE_COLS = ("LatestDocumentDate", "ExpirationDate", "AlertDate")


def cert_rows(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """SNK-14: submitted certificate rows as the table's columns, without an id."""
    return requests.select(*[
        (iso_date_or_null(col_of(src)) if dst in CERT_DATE_COLS else col_of(src).cast("string")).alias(dst)
        for src, dst in CERT_INSERT_KEYS.items()], *[col_of(c) for c in keep])


def cert_insert(table: DataFrame, requests: DataFrame) -> DataFrame:
    """SNK-14 as a next state: append submitted rows without an ``ID`` (the
    written form, with ids, is ``jobs.cert_insert_job``)."""
    return table.unionByName(cert_rows(requests), allowMissingColumns=True)
