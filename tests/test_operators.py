"""Operators of SURVEY §2.4–§2.8 on tiny frames, one case per FIXTURES row,
plus brute-force and partition-invariance properties."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.operators import aggs, filters, joins, projections, quality, tagging


# --- filters -----------------------------------------------------------------
def test_drop_ship_to_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,), (29744324,)], "s bigint")
    assert sorted(rows(filters.drop_value_keep_null(df, "s", 29744324)), key=str) == [(1,), (None,)]


def test_not_found_filter_runs_only_if_some_row_matches(spark):
    hit = spark.createDataFrame([("x",), ("Not found z",), (None,)], "z string")
    assert rows(filters.drop_containing_if_any(hit, "z", "Not found")) == [("x",)]
    miss = spark.createDataFrame([("x",), (None,)], "z string")
    assert sorted(rows(filters.drop_containing_if_any(miss, "z", "Not found")), key=str) == [("x",), (None,)]


def test_non_blank(spark):
    df = spark.createDataFrame([("a",), ("",), ("  ",), (None,), ("\t\n",), ("\u00a0",), ("\u2003\x1c",)], "u string")
    assert rows(filters.non_blank(df, "u")) == [("a",)]


def test_ready_with_contact_drops_dash_and_null(spark):
    df = spark.createDataFrame([("Ready", "a"), ("Ready", "-"), ("Ready", None), ("Done", "a")],
                               "send_email_status string, customer_contact string")
    assert rows(filters.ready_with_contact(df)) == [("Ready", "a")]


ALERTS = [("R1", "S1", "C1", "1", "", "Not Started"), ("R1", "S1", "C1", "2", "2024-01-01", "In Progress"),
          ("R2", "S2", "C2", "3", None, "Not Started"), ("R1", "S1", "C1", "4", "", "Completed"),
          ("R2", "S1", "C1", "5", "x", None)]
ALERT_SCHEMA = "Region string, SISentStatus string, shiptocountry string, ShiptoID string, DateDocumentSent string, Status string"


@pytest.mark.parametrize("modes,ids", [
    (["Active", "Archived"], {"1", "2"}), (["Active"], {"1"}), (["Archived"], {"2"}), ([], {"1", "2", "3"})])
def test_alert_modes(spark, modes, ids):
    df = spark.createDataFrame(ALERTS, ALERT_SCHEMA)
    got = {r[0] for r in filters.alert_search(df, modes=modes).select("ShiptoID").collect()}
    assert got == ids


def test_alert_facets_empty_list_means_no_filter(spark):
    df = spark.createDataFrame(ALERTS, ALERT_SCHEMA)
    got = {r[0] for r in filters.alert_search(df, regions=["R1"], statuses=[], countries=["C1"]).select("ShiptoID").collect()}
    assert got == {"1", "2"}


def test_alert_unknown_mode_rejected(spark):
    with pytest.raises(ValueError):
        filters.mode_predicate(["Active", "Soon"])


def test_not_completed_keeps_null(spark):
    df = spark.createDataFrame([("Completed",), (None,), ("Open",)], "Status string")
    assert sorted(rows(filters.drop_value_keep_null(df, "Status", "Completed")), key=str) == [("Open",), (None,)]


def test_starts_with_is_literal(spark):
    df = spark.createDataFrame([("a_b1",), ("axb1",), ("a%b",)], "k string")
    assert rows(filters.starts_with(df, "k", "a_b")) == [("a_b1",)]


# --- aggregates --------------------------------------------------------------
def test_rollup_cases(spark):
    data = [("S1", "U1", "b"), ("S1", "U1", "a"), ("S1", "U1", "a"), ("S1", "U1", None),
            (None, "U2", "é"), (None, "U2", "z"), ("S3", None, "x"), ("S3", "", "x"), ("S3", "  ", "y")]
    df = spark.createDataFrame(data, "ShiptoID string, UniqueID string, v string")
    out = filters.non_blank(aggs.distinct_rollup(df, ["ShiptoID", "UniqueID"], ["v"]), "UniqueID")
    assert sorted(rows(out)) == [("", "U2", "z;é"), ("S1", "U1", ";a;b")]


def test_rollup_numbers_and_null_text(spark):
    df = spark.createDataFrame([("s", "u", 29744324.0, None), ("s", "u", 0.5, 3), ("s", "u", float("nan"), 3)],
                               "ShiptoID string, UniqueID string, w double, n int")
    out = aggs.distinct_rollup(df, ["ShiptoID", "UniqueID"], ["w", "n"], null_text={"n": "nan"})
    assert rows(out) == [("s", "u", "0.5;29744324;NaN", "3;nan")]


def test_ordered_concat_refuses_a_null_value(spark):
    df = spark.createDataFrame([("k", "a"), ("k", None), (None, None)], "k string, v string")
    with pytest.raises(Exception, match="v is null"):
        aggs.ordered_concat(df, ["k"], "v").collect()
    kept = aggs.ordered_concat(df.where("v is not null or k is null"), ["k"], "v", sep="'")
    assert rows(kept) == [("k", "a")]


def test_rollup_invariant_under_order_and_partitioning(spark):
    rnd = random.Random(7)
    data = [(str(rnd.randint(0, 5)), str(rnd.randint(0, 20)), rnd.choice(["a", "b", None, "c", "ü"]))
            for _ in range(400)]
    schema = "ShiptoID string, UniqueID string, v string"
    base = sorted(rows(aggs.distinct_rollup(spark.createDataFrame(data, schema), ["ShiptoID", "UniqueID"], ["v"])))
    rnd.shuffle(data)
    other = spark.createDataFrame(data, schema).repartition(7)
    assert sorted(rows(aggs.distinct_rollup(other, ["ShiptoID", "UniqueID"], ["v"]))) == base


def test_ordered_concat(spark):
    data = [("c1", "A", "SO2", 2), ("c1", "A", "SO1", 1), ("c1", "A", "SO1", 3), ("c1", None, "SO9", 4),
            ("c2", "B", "SO5", 5)]
    df = spark.createDataFrame(data, "k1 string, k2 string, sales_organization string, o long")
    out = aggs.ordered_concat(df, ["k1", "k2"], "sales_organization", order_by=["o"])
    assert sorted(rows(out)) == [("c1", "A", "SO1;SO2;SO1"), ("c2", "B", "SO5")]
    assert aggs.ordered_concat(df.limit(0), ["k1", "k2"], "sales_organization").count() == 0


def test_nested_options_descending(spark):
    df = spark.createDataFrame([("FR", "a-1", "a-1"), ("FR", "b-2", "b-2"), ("DE", "c-3", "c-3")],
                               "country string, value string, label string")
    out = {r["country"]: [(o["value"], o["label"]) for o in r["options"]]
           for r in aggs.nested_options(df, "country", "value", "label").collect()}
    assert out == {"FR": [("b-2", "b-2"), ("a-1", "a-1")], "DE": [("c-3", "c-3")]}


def test_files_per_folder_and_distinct_null(spark):
    df = spark.createDataFrame([("f", "b.pdf"), ("f", "a.pdf"), (None, "c.pdf")], "folder_path string, file_name string")
    assert sorted(rows(aggs.files_per_folder(df)), key=str) == [("f", ["a.pdf", "b.pdf"]), (None, ["c.pdf"])]
    assert aggs.distinct_values(df, "folder_path").count() == 2


# --- tagging -----------------------------------------------------------------
def brute_dup(docs):
    seen, counter, out = set(), 1, []
    for d in docs:
        if d in seen:
            out.append(counter + 1)
            counter += 1
        else:
            seen.add(d)
            out.append(1)
    return out


def test_dup_tags_example(spark):
    docs = ["A", "B", "A", "B", "C", "A"]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(docs)], "doc string, pos long")
    got = [r["Dup_Value"] for r in tagging.dup_tags(df, "doc", "pos").orderBy("pos").collect()]
    assert got == [1, 1, 2, 3, 1, 4]


@pytest.mark.parametrize("n_ranges,parts", [(1, 1), (3, 5), (8, 2), (16, 8)])
def test_dup_tags_match_brute_force_for_any_partitioning(spark, n_ranges, parts):
    rnd = random.Random(n_ranges)
    docs = [rnd.choice("ABCDEFGH") if rnd.random() < 0.8 else "HOT" for _ in range(500)]
    pos = list(range(0, 1500, 3))
    data = list(zip(docs, pos))
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "doc string, pos long").repartition(parts)
    got = [r["Dup_Value"] for r in tagging.dup_tags(df, "doc", "pos", n_ranges=n_ranges).orderBy("pos").collect()]
    assert got == brute_dup(docs)


def test_ranges_are_of_equal_depth_however_positions_lie(spark):
    """An outlier, a dense stretch and a sparse one: no range exceeds twice the mean."""
    rnd = random.Random(3)
    shapes = {"outlier": [*range(20_000), 2 ** 60], "far": [*range(10_000), *range(2 ** 50, 2 ** 50 + 10_000), 2 ** 61],
              "sparse": sorted({int(rnd.random() ** 8 * 2 ** 40) for _ in range(20_000)}), "one": [5], "low": [-2 ** 40, 0, 1, 2]}
    for pos in shapes.values():
        df = spark.createDataFrame([(p,) for p in pos], "pos long")
        cuts = tagging.equi_depth_cuts(df, "pos", 16)
        assert cuts == sorted(set(cuts)) and cuts[0] == min(pos)
        depth = [sum(a <= p < b for p in pos) for a, b in zip(cuts, [*cuts[1:], 2 ** 63])]
        assert sum(depth) == len(pos) and max(depth) <= 2 * max(1, len(pos) / 16)
    assert tagging.equi_depth_cuts(spark.createDataFrame([], "pos long"), "pos", 16) == []
    pos = shapes["outlier"]
    docs = [rnd.choice("ABC") for _ in pos]
    df = spark.createDataFrame(list(zip(docs, pos)), "doc string, pos long").repartition(3)
    got = [r["Dup_Value"] for r in tagging.dup_tags(df, "doc", "pos", n_ranges=16).orderBy("pos").collect()]
    assert got == brute_dup(docs)


def test_a_hot_key_is_concatenated_in_pieces(spark):
    """A third of the rows has one key: its list is whole and in order, and the
    pieces it is made of are spread over partitions."""
    hot = [("hot", i * 7919 % 3000, f"v{i % 5}") for i in range(3000)]
    rest = [(f"k{i % 2000}", i, f"w{i}") for i in range(6000)]
    df = spark.createDataFrame(hot + rest + hot[:2], "k string, o long, v string").repartition(6)
    out = {r["k"]: r["v"] for r in aggs.ordered_concat(df, ["k"], "v", order_by=["o"]).collect()}
    want = {}
    for k, o, v in sorted(hot + rest + hot[:2], key=lambda r: (r[1], r[2])):
        want.setdefault(k, []).append(v)
    assert out == {k: ";".join(v) for k, v in want.items()}
    ranged = df.repartitionByRange(8, "k", "o", "v").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) <= 2 * 9002 / 8


def test_dup_tags_per_batch(spark):
    data = [("b1", "A", 0), ("b1", "A", 1), ("b2", "A", 0), ("b2", "B", 1), ("b2", "A", 2), ("b2", "B", 3)]
    df = spark.createDataFrame(data, "batch string, doc string, pos long")
    out = {(r["batch"], r["pos"]): r["Dup_Value"] for r in tagging.dup_tags(df, "doc", "pos", batch_col="batch").collect()}
    assert out == {("b1", 0): 1, ("b1", 1): 2, ("b2", 0): 1, ("b2", 1): 1, ("b2", 2): 2, ("b2", 3): 3}


def test_unique_value_and_syslog_id(spark):
    df = spark.createDataFrame([('{"Sales_Document": 7, "SAP_Shipment": "S1"}', 2),
                                ('{"SAP_Shipment": "S9"}', 1), ('{"Sales_Document": null}', 1)], "raw string, Dup_Value long")
    out = df.select(tagging.syslog_id("raw").alias("id")).collect()
    assert [r["id"] for r in out] == ["7", "S9", None]
    import datetime as dt
    v = df.select(tagging.unique_value(F.lit("7"), dt.datetime(2024, 3, 5, 6, 7, 8)).alias("u")).first()["u"]
    assert v == "7-0503060708-2"


# --- joins ---------------------------------------------------------------------
def test_prefix_join_matches_brute_force(spark):
    keys = [f"{a}{b}" for a in ["inv_1", "inv_12", "inv_2", "x"] for b in ["_a.pdf", "3_b.pdf", ""]]
    stems = ["inv_1", "inv_12", "inv_2", "inv_9", "i"]  # an empty stem matches nothing
    kdf = spark.createDataFrame([(k,) for k in keys], "file_name string")
    sdf = spark.createDataFrame([(s,) for s in [*stems, "", None]], "stem string")
    assert joins.empty_stems(sdf, "stem").count() == 2
    got = sorted(rows(joins.prefix_join(kdf, "file_name", sdf, "stem")))
    assert got == sorted((k, s) for k in keys for s in stems if k.startswith(s))
    anti = sorted(rows(joins.prefix_join(kdf, "file_name", sdf, "stem", "left_anti")))
    assert anti == sorted((k,) for k in keys if not any(k.startswith(s) for s in stems))
    semi = sorted(rows(joins.prefix_join(kdf, "file_name", sdf, "stem", "left_semi")))
    assert semi == sorted((k,) for k in keys if any(k.startswith(s) for s in stems))


def test_prefix_join_without_stems(spark):
    kdf = spark.createDataFrame([("a",)], "file_name string")
    sdf = spark.createDataFrame([], "stem string")
    assert joins.prefix_join(kdf, "file_name", sdf, "stem").count() == 0
    assert joins.prefix_join(kdf, "file_name", sdf, "stem", "left_anti").count() == 1


ODD_TEXTS = ["", "a", "a\x01b", "\x02", "\x02a", "\x02n", "\x01", "b;c", None, "\x02b\x01", "n"]


def test_rollup_and_changes_ship_one_text_a_row(spark):
    """Any text comes back from the packed rows, and an exchange carries the keys
    and one text, however many columns there are."""
    data = [(str(k % 3), "u", *(ODD_TEXTS[(k * 7 + i) % 11] for i in range(4))) for k in range(40)]
    schema = "ShiptoID string, UniqueID string, a string, b string, c string, `d.e` string"
    df, cols = spark.createDataFrame(data, schema), ["a", "b", "c", "d.e"]
    rolled = aggs.distinct_rollup(df, ["ShiptoID", "UniqueID"], cols)
    want = {(k, "u", *(";".join(sorted({r[2 + i] or "" for r in data if r[0] == k})) for i in range(4))) for k in "012"}
    assert {tuple(r) for r in rolled.collect()} == want
    new = spark.createDataFrame([(str(i), "u", *(ODD_TEXTS[(i + j) % 11] for j in range(4))) for i in range(11)], schema)
    old = spark.createDataFrame([(str(i), "u", *(ODD_TEXTS[(i * 2 + j * (i % 3)) % 11] for j in range(4))) for i in range(11)], schema)
    before = {r[0]: r for r in old.collect()}
    diff = joins.snapshot_changes(new, old, ["ShiptoID", "UniqueID"], cols)
    assert sorted(map(tuple, diff.collect()), key=str) == sorted(
        [(r[0], "u", c, before[r[0]][2 + i], r[2 + i]) for r in new.collect() for i, c in enumerate(cols)
         if before[r[0]][2 + i] != r[2 + i]], key=str)
    for out in (rolled, joins.snapshot_changes(new, old, ["ShiptoID", "UniqueID"], cols)):
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        sent = [plan[k + 1] for k, line in enumerate(plan) if "Exchange hashpartitioning" in line]
        assert sent and all("Project [" in x or "Filter" in x for x in sent) and not any("Aggregate" in x for x in sent)
        assert all("'" not in x and x.count(" AS __") == 1 for x in sent if "Project [" in x)


def test_snapshot_changes_null_safe_and_one_sided_keys(spark):
    old = spark.createDataFrame([("s", "1", "a", "x"), ("s", "2", "b", None), ("s", "3", "c", "z")],
                                "ShiptoID string, UniqueID string, A string, B string")
    new = spark.createDataFrame([("s", "1", "a", "y"), ("s", "2", "b", None), ("s", "4", "q", "q")],
                                "ShiptoID string, UniqueID string, A string, B string")
    out = rows(joins.snapshot_changes(new, old, ["ShiptoID", "UniqueID"], ["A", "B"]))
    assert out == [("s", "1", "B", "x", "y")]


def test_codes_join_fans_out(spark):
    cust = spark.createDataFrame([("1", "UN")], "ship_to string, ship_to_country string")
    codes = spark.createDataFrame([("UN", "UNITED KINGDOM"), ("UN", "UNITED STATES")], "alpha_2code string, country_name string")
    assert joins.codes_inner(cust, codes, "ship_to_country", "alpha_2code").count() == 2


# --- projections / quality ---------------------------------------------------------
def test_positional_rename_checks_width(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert projections.rename_by_position(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(projections.SchemaMismatch):
        projections.rename_by_position(df, ["x"])


def test_select_renamed_with_dotted_names(spark):
    df = spark.createDataFrame([("1", "2")], "`SalesDocno.` string, other string")
    assert projections.select_renamed(df, {"SalesDocno.": "SalesDocno"}).columns == ["SalesDocno"]
    with pytest.raises(projections.SchemaMismatch):
        projections.select_renamed(df, {"missing": "m"})


def test_insert_copy_at_position(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, sea_freight int, c int")
    assert projections.insert_copy(df, "sea_freight", "BAF", 2).columns == ["a", "sea_freight", "BAF", "c"]


def test_salvage_split(spark):
    df = spark.createDataFrame([("1", "2.5", "ok"), ("x", "1", "ok"), (None, "y", "ok"), ("3", None, "a" * 300)],
                               "n string, d string, t string")
    good, bad = quality.split_by_cast(df, {"n": "bigint", "d": "double"}, {"t": 255})
    assert rows(good) == [(1, 2.5, "ok")]
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["d: not double", "n: not bigint", "t: longer than 255"]


def test_building_a_join_runs_no_job(spark):
    big = spark.range(50).withColumnRenamed("id", "k")
    small = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "k long, v string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no-job", "none")
    out = joins.codes_inner(joins.lookup_left(big, small, "k", "k"), small.withColumnRenamed("v", "w"), "k", "k")
    assert not tracker.getJobIdsForGroup("no-job")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() == 10


def test_dup_tags_hot_document_third_of_rows(spark):
    rnd = random.Random(3)
    docs = ["HOT" if i % 3 == 0 else f"d{rnd.randint(0, 400)}" for i in range(3000)]
    df = spark.createDataFrame(list(zip(docs, range(3000))), "doc string, pos long").repartition(6)
    got = [r["Dup_Value"] for r in tagging.dup_tags(df, "doc", "pos").orderBy("pos").collect()]
    assert got == brute_dup(docs)


def test_dup_tags_join_the_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("A", 0), ("B", 1), ("A", 2)], "doc string, pos long")
        plan = tagging.dup_tags(df, "doc", "pos")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join Inner") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dup_tags_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "doc string, pos long, post string")
    assert tagging.dup_tags(df, "doc", "pos").count() == 0
    assert tagging.dup_tags(df, "doc", "pos", "post").count() == 0
