"""Audit rows both ways, retention by months, and the smaller jobs beside them."""

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkledger.operators import audit, partitions
from sparkledger.plans import hygiene, ledger, status
from sparkledger.session import shared_folder, snapshot

ROW = "a long, b string, name string, amount decimal(18,2), day date, at timestamp_ntz, ok boolean, ratio double"
PK = ["a", "b"]


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def row(a, b, name="x", amount="1.50", day=datetime.date(2024, 1, 31), ok=True, ratio=0.1):
    return (a, b, name, None if amount is None else Decimal(amount), day, datetime.datetime(2024, 1, 1, 2, 3, 4, 567), ok, ratio)


def versions(spark):
    """Updates with NULLs in both directions, deletes, inserts, a row that leaves and comes back, one that comes and goes."""
    return [
        spark.createDataFrame(rows, ROW)
        for rows in (
            [row(1, "p"), row(1, "q", name=None), row(2, "p"), row(3, "p", amount=None, ok=None)],
            [row(1, "p", name=None, amount=None), row(1, "q", name="new"), row(4, "p", day=None), row(3, "p", amount=None, ok=None)],
            [row(1, "p", name="z", amount=None), row(2, "p", name="", ratio=float("nan")), row(5, "p"), row(3, "p", ok=False, ratio=-0.0)],
            [row(1, "p", name="z"), row(2, "p", name=None), row(4, "p", name="again")],
        )
    ]


def history(spark, tables):
    told, highest = None, 0
    for hour, (before, after) in enumerate(zip(tables, tables[1:]), start=1):
        found = audit.audit_rows(before, after, PK, "t", f"2024-01-01 0{hour}:00:00", 3, highest)
        highest += found.header.count()
        told = found if told is None else told.union(found)
    return told


def test_versions_come_back_from_their_audit_rows(spark):
    tables = versions(spark)
    told = history(spark, tables)
    assert told.header.select("audit_hdr_id").distinct().count() == told.header.count()
    for hour, table in enumerate(tables):
        assert same(audit.rows_at(tables[-1], told, PK, "t", f"2024-01-01 0{hour}:30:00"), table)
    # Other tables' changes, and kinds that change nothing, are left alone.
    assert same(audit.rows_at(tables[-1], told, PK, "other", "2024-01-01 00:30:00"), tables[-1])


def test_audit_rows_of_a_difference(spark):
    first, second = versions(spark)[:2]
    told = audit.audit_rows(first, second, PK, "t", "2024-01-01 00:00:00", 3, highest=10)
    kinds = {r["audit_hdr_id"]: r["change_type"] for r in told.header.collect()}
    # In the order of the key: two updates, a delete, an insert; the row that did not change is absent.
    assert kinds == {11: 2, 12: 2, 13: 3, 14: 1}
    fields = {(r["audit_hdr_id"], r["fld_name"]): (r["old_fld_value"], r["new_fld_value"]) for r in told.field.collect()}
    assert fields[11, "name"] == ("x", None) and fields[11, "amount"] == ("1.50", None) and fields[12, "name"] == (None, "new")
    assert len([1 for n, _ in fields if n == 11]) == 2 and (14, "day") not in fields
    keys = {(r["audit_hdr_id"], r["fld_name"]): (r["old_fld_value"], r["new_fld_value"]) for r in told.key.collect()}
    assert keys[13, "a"] == ("2", None) and keys[14, "a"] == (None, "4") and keys[11, "b"] == ("p", "p") and len(keys) == 8


def test_equal_and_empty_versions_have_no_audit_rows(spark):
    table = versions(spark)[0]
    empty = table.where("1 = 0")
    for before, after in ((table, table), (empty, empty)):
        told = audit.audit_rows(before, after, PK, "t", "2024-01-01 00:00:00", 3)
        assert told.header.isEmpty() and told.key.isEmpty() and told.field.isEmpty()
    told = audit.audit_rows(table, empty, PK, "t", "2024-01-01 01:00:00", 3)
    assert same(audit.rows_at(empty, told, PK, "t", "2024-01-01 00:00:00"), table)


def test_audit_of_a_table_that_is_all_key(spark):
    first, second = spark.createDataFrame([(1, "x"), (2, "x")], "a long, b string"), spark.createDataFrame([(2, "x"), (3, "x")], "a long, b string")
    told = audit.audit_rows(first, second, PK, "t", "2024-01-01 01:00:00", 3)
    assert told.field.isEmpty() and told.header.count() == 2
    assert same(audit.rows_at(second, told, PK, "t", "2024-01-01 00:00:00"), first)


def test_audit_refuses_null_keys_and_unreadable_columns(spark):
    table = versions(spark)[0]
    with pytest.raises(PySparkException, match="must not be NULL"):
        audit.audit_rows(table, table.withColumn("b", F.lit(None).cast("string")), PK, "t", "2024-01-01", 3)
    with pytest.raises(ValueError, match="raw"):
        audit.audit_rows(table.withColumn("raw", F.lit(b"1")), table.withColumn("raw", F.lit(b"1")), PK, "t", "2024-01-01", 3)


def test_a_row_with_a_third_of_all_changes(spark, capsys):
    changes = spark.range(30_000).selectExpr("id AS audit_hdr_id", "timestamp_ntz'2024-01-02' + make_dt_interval(0, 0, 0, id) AS audit_dt", "2 AS change_type", "3L AS user_id", "'t' AS tbl_name")
    key = spark.range(30_000).selectExpr("id AS audit_hdr_id", "'a' AS fld_name", "CAST(IF(id % 3 = 0, 0, id) AS STRING) AS old_fld_value", "CAST(NULL AS STRING) AS new_fld_value")
    field = spark.range(30_000).selectExpr("id AS audit_hdr_id", "'v' AS fld_name", "CAST(id AS STRING) AS old_fld_value", "'now' AS new_fld_value")
    current = spark.range(30_000).where("id % 3 <> 0 OR id = 0").selectExpr("id AS a", "'now' AS v")
    then = audit.rows_at(current, audit.Audit(changes, key, field), ["a"], "t", "2024-01-01")
    then.explain()
    assert "partial_min" in capsys.readouterr().out
    assert then.where("v <> CAST(a AS STRING)").isEmpty() and then.count() == current.count()


# Retention by months -----------------------------------------------------------------------------

DATED = "id long, d1 date, d2 date"


def files(path):
    return {os.path.join(f, n): os.stat(os.path.join(f, n)).st_mtime_ns for f, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_expired_months_leave_and_later_ones_keep_their_files(spark, tmp_path, capsys):
    day = datetime.date
    rows = [
        (1, day(2023, 11, 1), day(2023, 11, 2)), (2, day(2023, 12, 31), day(2023, 12, 1)), (3, day(2023, 1, 1), day(2024, 1, 14)), (4, day(2024, 1, 15), day(2023, 1, 1)),
        (5, day(2024, 1, 20), day(2024, 1, 1)), (6, day(2024, 2, 1), day(2023, 1, 1)), (7, None, day(2020, 1, 1)), (0, day(2020, 1, 1), day(2020, 1, 1)),
    ]
    table, path, dates = spark.createDataFrame(rows, DATED), str(tmp_path / "dated"), ("d1", "d2")
    partitions.write_dated(table, path, dates, nonzero=("id",))
    before = files(path)
    gone = partitions.expired(partitions.read_dated(spark, path, table.schema), dates, "2024-01-16", 1)
    assert sorted(r["id"] for r in gone.collect()) == [1, 2, 3]
    gone.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(period" in plan
    assert partitions.drop_expired(spark, path, table.schema, dates, "2024-01-16", 1) == [202311, 202312]
    left = partitions.read_dated(spark, path, table.schema).drop("period")
    assert sorted(r["id"] for r in left.collect()) == [0, 4, 5, 6, 7]
    after = files(path)
    untouched = {name for name in before if "period=202402" in name or partitions.KEPT in name}
    assert len(untouched) >= 2 and all(after[name] == before[name] for name in untouched)
    # Again: nothing more to do.
    assert partitions.drop_expired(spark, path, table.schema, dates, "2024-01-16", 1) == []
    assert sorted(r["id"] for r in partitions.read_dated(spark, path, table.schema).collect()) == [0, 4, 5, 6, 7]


def test_a_table_all_of_whose_months_left_is_empty(spark, tmp_path):
    table, path = spark.createDataFrame([(1, datetime.date(2020, 1, 1), None), (2, datetime.date(2020, 1, 9), None)], DATED), str(tmp_path / "dated")
    partitions.write_dated(table, path, ("d1",))
    # The month of the cutoff itself: all of its rows are older.
    assert partitions.drop_expired(spark, path, table.schema, ("d1",), "2020-01-20", 0) == []
    left = partitions.read_dated(spark, path, table.schema)
    assert left.isEmpty() and left.columns == ["id", "d1", "d2", "period"]


# Smaller jobs ------------------------------------------------------------------------------------

def test_archived_versions_are_dropped_and_others_refused(spark, tmp_path):
    folder = str(tmp_path)
    frame = spark.createDataFrame([(1,)], "k long")
    hygiene.rotate_backup(frame, folder, "bk", "1", None, "2024-01-01")
    with pytest.raises(RuntimeError, match="not in the archive"):
        hygiene.drop_archived(spark, folder, "bk", "1")
    archive = hygiene.rotate_backup(frame, folder, "bk", "2", "1", "2024-01-02")
    hygiene.drop_archived(spark, folder, "bk", "1")
    hygiene.drop_archived(spark, folder, "bk", "1")
    assert not os.path.exists(f"{folder}/bk/version=1") and os.path.exists(f"{folder}/bk/version=2") and archive.count() == 1


def test_codes_mapped_by_a_table_go_back(spark):
    table = spark.createDataFrame([(1, "ROL"), (2, "EUR"), (3, "RON"), (4, None)], "id long, code string")
    mapping = spark.createDataFrame([("ROL", "RON")], "old_code string, new_code string")
    rows = snapshot(ledger.mapped_codes(table, ["id"], "code", mapping))
    changed = ledger.apply_codes(table, rows, ["id"], "code")
    assert {r["id"]: r["code"] for r in changed.collect()} == {1: "RON", 2: "EUR", 3: "RON", 4: None}
    assert same(ledger.restore_codes(changed, rows, ["id"], "code"), table)
    twice = spark.createDataFrame([("ROL", "RON"), ("ROL", "XXX")], "old_code string, new_code string")
    with pytest.raises(PySparkException, match="several update rows"):
        ledger.apply_codes(table, ledger.mapped_codes(table, ["id"], "code", twice), ["id"], "code").collect()


def test_current_address_of_affected_assets(spark):
    day = datetime.date(2024, 1, 1)
    affected = spark.createDataFrame([(1, 10, 5, day), (1, 11, 0, day), (1, 11, 0, day)], "contract_id long, asset_hdr_id long, delivery_address_id long, calc_dt date")
    contract = spark.createDataFrame([(1, 77)], "contract_id long, default_asset_address_id long")
    wanted = status.affected_addresses(affected, contract)
    assert sorted(tuple(r) for r in wanted.collect()) == [(10, 5, day), (11, 77, day)]
    address = spark.createDataFrame([(1, 10, 45101, day, 9)], "asset_hdr_address_id long, asset_hdr_id long, asset_hdr_address_type int, effective_dt date, address_id long")
    asset_hdr = spark.createDataFrame([(10, 0), (11, 0), (12, 3)], "asset_hdr_id long, current_address_id long")
    change = status.write_current_addresses(asset_hdr, status.address_changes(wanted, address))
    # Asset 10 was given an address by hand on that day.
    after = change.apply(asset_hdr)
    assert {r["asset_hdr_id"]: r["current_address_id"] for r in after.collect()} == {10: 0, 11: 77, 12: 3}
    assert same(change.revert(after), asset_hdr)


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn", ""])
def test_a_cluster_needs_a_shared_folder(master):
    class Session:
        conf = {"spark.master": master}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)
