"""Sums moved by deltas, and the composed repair of tax lines."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkledger import registry
from sparkledger.operators import deltas, joins, posting
from sparkledger.operators.changeset import ChangeSet
from sparkledger.plans import ledger, repair
from sparkledger.session import snapshot
from sparkledger.sources.fixtures import Fixtures

LINE = "id long, flow_id long, amt_tax decimal(18,2)"
KEYS, MEASURES = ["flow_id"], ["amt_tax"]


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def lines(spark, rows):
    return spark.createDataFrame([(i, f, None if a is None else Decimal(a)) for i, f, a in rows], LINE)


@pytest.fixture(scope="module")
def fx(spark, data):
    return Fixtures(spark, data)


def test_sums_moved_by_three_runs_are_those_of_the_table(spark):
    table = snapshot(lines(spark, [(1, 1, 10), (2, 1, 5), (3, 2, 7), (4, 3, None), (5, None, 9), (6, 4, 1)]))
    stored = snapshot(deltas.sums(table, KEYS, MEASURES))
    runs = [
        # A line goes and another changes its amount; the last line of a flow goes.
        dict(updates=lines(spark, [(1, 0, 11)]).select("id", "amt_tax"), deletes=lines(spark, [(2, 0, 0), (3, 0, 0)]).select("id")),
        # A line moves to another flow, one without a flow gets one, a flow is new.
        dict(updates=lines(spark, [(6, 1, 2), (5, 4, 9)]).select("id", "flow_id", "amt_tax"), inserts=lines(spark, [(7, 9, 3), (8, 9, -3)])),
        # Old and new lines cancel out; a line loses its flow.
        dict(updates=lines(spark, [(4, None, 1)]).select("id", "flow_id", "amt_tax"), deletes=lines(spark, [(1, 0, 0)]).select("id"), inserts=lines(spark, [(9, 1, 11)])),
    ]
    for parts in runs:
        change = ChangeSet.capture(table, ["id"], **parts)
        moved = deltas.move_sums(stored, change, KEYS, MEASURES)
        table, stored = snapshot(change.apply(table)), snapshot(moved.apply(stored))
        assert same(stored, deltas.sums(table, KEYS, MEASURES))
    assert stored.where("flow_id = 1").first()["n_rows"] == 2 and stored.where("flow_id IN (2, 3)").isEmpty()


def test_sums_go_back_with_the_change(spark):
    table = snapshot(lines(spark, [(1, 1, 10), (2, 2, 5)]))
    stored = snapshot(deltas.sums(table, KEYS, MEASURES))
    change = ChangeSet.capture(table, ["id"], inserts=lines(spark, [(3, 3, 1)]), deletes=lines(spark, [(2, 0, 0)]).select("id"))
    moved = deltas.move_sums(stored, change, KEYS, MEASURES)
    assert same(moved.revert(moved.apply(stored)), stored)


def test_an_empty_change_moves_nothing(spark):
    table = snapshot(lines(spark, [(1, 1, 10)]))
    change = ChangeSet.capture(table, ["id"], deletes=lines(spark, []).select("id"))
    stored = snapshot(deltas.sums(table, KEYS, MEASURES))
    assert deltas.deltas(change, KEYS, MEASURES).isEmpty()
    assert same(deltas.move_sums(stored, change, KEYS, MEASURES).apply(stored), stored)


def test_deltas_read_changed_rows_only(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines(spark, [(i, i % 10, 1) for i in range(1000)]).write.parquet(path)
    table = spark.read.parquet(path)
    change = ChangeSet.capture(table, ["id"], deletes=lines(spark, [(3, 0, 0)]).select("id"))
    assert not any(path in name for name in deltas.deltas(change, KEYS, MEASURES).inputFiles())


def test_a_flow_with_a_third_of_the_changes(spark, capsys):
    rows = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, 0, id) AS flow_id", "CAST(1 AS DECIMAL(18,2)) AS amt_tax")
    change = ChangeSet(["id"], rows.where("1 = 0"), inserts=rows)
    moved = deltas.deltas(change, KEYS, MEASURES)
    assert moved.where("flow_id = 0").first()["n_rows"] == 10_000
    moved.explain()
    # Each task sums its share of the flow before anything is shuffled.
    assert "partial_sum" in capsys.readouterr().out


def test_sums_of_another_table_are_refused(spark):
    table = snapshot(lines(spark, [(1, 1, 10), (2, 1, 10)]))
    change = ChangeSet.capture(table, ["id"], deletes=lines(spark, [(1, 0, 0), (2, 0, 0)]).select("id"))
    stored = snapshot(deltas.sums(table.where("id = 1"), KEYS, MEASURES))
    with pytest.raises(PySparkException, match="do not belong"):
        deltas.move_sums(stored, change, KEYS, MEASURES)


def test_repair_adds_up_and_goes_back(spark, fx, tmp_path):
    run, lazy = registry._repair(fx)
    folder, log = str(tmp_path / "tables"), str(tmp_path / "log")
    for name, table in lazy.items():
        posting.write_version(table, folder, name, "1")
    posting.switch(spark, folder, dict.fromkeys(lazy, "1"))
    tables = posting.current_tables(spark, folder)
    # Both kinds of flow occur: reversed ones, and open ones that lost lines.
    change = run.posting.changes["flow"]
    assert run.reversal.before.count() > 0 and change.before.count() > run.reversal.before.count()
    run.publish(tables, folder, "2", log, "2002-01-01 00:00:00", 3)
    after = posting.current_tables(spark, folder)
    assert set(posting.current_versions(spark, folder)[1].values()) == {"2"}
    assert same(after["flow_tax_sum"], deltas.sums(after["tax_calc_flow"], repair.SUM_KEYS, repair.SUM_MEASURES))
    # Every current flow that the run touched adds up, and no invalid line is left on a current flow.
    touched = change.before.select("flow_id").unionByName(change.inserts.select("flow_id"))
    assert ledger.tax_mismatches(after["flow"].join(touched, "flow_id", "left_semi"), after["tax_calc_flow"]).isEmpty()
    current = after["flow"].where("reversal_status = 4200").select("flow_id")
    assert after["tax_calc_flow"].join(run.invalid.select("tax_calc_flow_id"), "tax_calc_flow_id", "left_semi").join(current, "flow_id", "left_semi").isEmpty()
    assert after["contract"].where("save_status = 2201").count() == run.invalid.select("contract_id").distinct().count()
    assert run.counters(tables).first()["next_no"] == after["flow"].agg(F.max("flow_id")).first()[0] + 1
    run.posting.publish(after, folder, "3", log, "2002-01-02 00:00:00", 3, back=True)
    back = posting.current_tables(spark, folder)
    assert all(same(back[name], tables[name]) for name in tables)


def test_repair_that_does_not_add_up_is_not_published(spark, fx, tmp_path):
    run, tables = registry._repair(fx)
    change = run.posting.changes["flow"]
    wrong = change.inserts.withColumn("amt_gross", (F.col("amt_gross") + 1).cast("decimal(18,2)"))
    run.posting.changes["flow"] = ChangeSet(change.pk, change.before, change.updates, wrong, change.deletes)
    with pytest.raises(RuntimeError, match="nothing was published"):
        run.publish(tables, str(tmp_path / "tables"), "2", str(tmp_path / "log"), "2002-01-01 00:00:00", 3)
    assert posting.current_versions(spark, str(tmp_path / "tables")) == (0, {})


def test_lines_of_other_flows_are_dropped_before_the_shuffle(fx, monkeypatch):
    """Of the tax lines only those of flows that may hold an invalid line, or of the reversed flows, are joined."""
    kept = []

    def counted(rows, others, keys):
        found = joins.possible(rows, others, keys)
        kept.append((rows.count(), found.count()))
        return found

    monkeypatch.setattr(ledger, "possible", counted)
    reversal, invalid = registry._tax_reversal(fx)
    ledger.reversal_tax_lines(reversal.key_map, fx.tax(), invalid)
    assert len(kept) == 2 and all(found < n / 2 for n, found in kept)


def test_known_mismatches_sum_only_their_own_lines(fx, monkeypatch):
    """The flows of the affected contracts are few: their taxes are not summed from the whole table."""
    summed, mismatches = [], ledger.tax_mismatches
    monkeypatch.setattr(ledger, "tax_mismatches", lambda flow, tax, *more: summed.append(tax.count()) or mismatches(flow, tax, *more))
    registry._repair(fx)
    assert len(summed) == 1 and summed[0] < fx.tax().count() / 2
