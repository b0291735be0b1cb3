"""Column profiles by sketches against exact counts."""

import __spark_entry__ as entry_point
from sparkledger.plans import discovery, profiles
from sparkledger.registry import ESTIMATES, QUERIES
from sparkledger.session import snapshot


def by_column(rows):
    return {(r["table_name"], r["column_name"]): r for r in rows.collect()}


def test_estimates_are_near_the_exact_counts(spark, data):
    assert not set(ESTIMATES) & set(QUERIES) and ESTIMATES.items() <= entry_point.queries().items()
    exact, found = by_column(QUERIES["profile_columns"](spark, data)), by_column(ESTIMATES["profile_sketches"](spark, data))
    assert set(found) == set(exact)
    for column, r in found.items():
        assert all(r[c] == exact[column][c] for c in ("n_rows", "n_nulls", "min_value", "max_value"))
        # Five standard errors.
        assert abs(r["n_distinct_estimate"] - exact[column]["n_distinct"]) <= 0.04 * exact[column]["n_distinct"]


def test_no_row_is_multiplied(spark, data, capsys):
    table = spark.read.parquet(f"{data}/lineitem.parquet")
    profiles.profile(table, ["l_orderkey", "l_partkey", "l_tax", "l_shipdate"]).explain()
    assert "Expand" not in capsys.readouterr().out
    discovery.profile_columns({"lineitem": table}, "l_*key").explain()
    assert "Expand" in capsys.readouterr().out


def test_a_new_part_reads_its_own_rows_only(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.range(0, 20_000).selectExpr("id", "id % 100 AS v").write.parquet(old)
    spark.range(10_000, 30_000).selectExpr("id", "id % 100 - 50 AS v").write.parquet(new)
    stored = snapshot(profiles.profile(spark.read.parquet(old), ["id", "v"]))
    merged = profiles.merge(stored.unionByName(profiles.profile(spark.read.parquet(new), ["id", "v"])))
    assert not any(old in name for name in merged.inputFiles())
    found = by_column(profiles.report("t", merged))
    assert found["t", "id"]["n_rows"] == 40_000 and abs(found["t", "id"]["n_distinct_estimate"] - 30_000) < 1_200
    # Numbers are compared as numbers.
    assert (found["t", "v"]["min_value"], found["t", "v"]["max_value"]) == ("-50", "99")


def test_nothing_and_nulls(spark):
    empty = spark.createDataFrame([], "v string, d date")
    nulls = spark.createDataFrame([(None, None), (None, None)], "v string, d date")
    for rows, n in ((empty, 0), (nulls, 2)):
        merged = profiles.merge(profiles.profile(rows, ["v", "d"]).unionByName(profiles.profile(empty, ["v", "d"])))
        found = by_column(profiles.report("t", merged))
        assert all(r["n_rows"] == r["n_nulls"] == n and r["min_value"] is None and r["n_distinct_estimate"] == 0 for r in found.values())
