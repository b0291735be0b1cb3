"""One key holding a third of all rows: whole results, and hot partitions that are split."""

import contextlib

import pytest
from pyspark.sql import functions as F

from sparkledger.operators import joins, keys, updates
from sparkledger.operators.changeset import ChangeSet
from sparkledger.operators.hierarchy import ancestor_pairs
from sparkledger.plans import ledger, listing, status

ROWS = 240_000
HOT = 7


@contextlib.contextmanager
def conf(spark, **settings):
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def small_partitions(spark):
    """Cluster behaviour in small: nothing is broadcast, and a partition counts as hot early."""
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        },
    ):
        yield


def hot(spark, key, n=ROWS, keys=5_000):
    """`n` rows, a third of them with one key."""
    return spark.range(0, n, 1, 8).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % keys).cast("bigint").alias(key)
    )


def final_plan(df, capsys):
    df.collect()
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_inner_and_left_joins_split_the_hot_partition(spark, small_partitions, capsys):
    facts = hot(spark, "k").withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
    dimension = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi"):
        joined = facts.join(dimension, "k", how)
        plan = final_plan(joined, capsys)
        assert "skew=true" in plan
        assert joined.count() == ROWS


def test_semi_and_anti_reduce_the_hot_other_side(spark, small_partitions):
    rows = spark.range(10_000).select(F.col("id").alias("k"))
    others = hot(spark, "k")
    assert joins.semi(rows, others, ["k"]).count() == others.select("k").distinct().count()
    assert joins.anti(rows, others, ["k"]).count() == 10_000 - others.select("k").distinct().count()


def test_left_join_many_is_a_left_join(spark, small_partitions):
    rows = spark.range(10_000).select(F.col("id").alias("k"))
    many = hot(spark, "k")
    joined = joins.left_join_many(rows, many, ["k"])
    expected = rows.join(many, "k", "left")
    assert joined.count() == expected.count()
    assert joined.exceptAll(expected).isEmpty()


def test_semi_any_with_a_hot_contract(spark, small_partitions):
    rows = hot(spark, "contract_id").selectExpr("id", "contract_id", "id % 1000 AS a", "id % 100 AS b", "id % 10 AS c")
    assets = spark.range(1_000).selectExpr("7L AS contract_id", "id * 5 AS asset")
    got = joins.semi_any(rows, ["id"], ["a", "b", "c"], assets, "asset", same=["contract_id"])
    expected = rows.where("contract_id = 7 AND (a % 5 = 0 OR b % 5 = 0 OR c % 5 = 0)")
    assert got.count() == expected.count() == got.join(expected, got.columns, "left_semi").count() > 0


def test_latest_row_of_a_hot_key(spark, small_partitions):
    rows = hot(spark, "k").selectExpr("k", "id", "date_add(DATE '2024-01-01', CAST(id % 60 AS INT)) AS dt", "id * 2 AS v")
    got = joins.latest_as_of(rows, ["k"], "dt", "id", "2024-01-31", ["v"]).where(f"k = {HOT}").collect()
    expected = rows.where(f"k = {HOT} AND dt <= DATE '2024-01-31'").orderBy(F.desc("dt"), F.desc("id")).first()
    assert [(r["dt"], r["id"], r["v"]) for r in got] == [(expected["dt"], expected["id"], expected["v"])]


def test_address_changes_of_a_hot_asset(spark, small_partitions):
    address = hot(spark, "asset_hdr_id").selectExpr(
        "asset_hdr_id", "id AS asset_hdr_address_id", "45101 AS asset_hdr_address_type",
        "date_add(DATE '2024-01-01', CAST(id % 50 AS INT)) AS effective_dt", "id % 500 AS address_id",
    )
    candidates = spark.createDataFrame([(HOT, 99, "2024-03-01"), (HOT, 98, "2024-03-01"), (4_999_999, 1, "2024-03-01")], "asset_hdr_id long, address_id long, d string")
    candidates = candidates.select("asset_hdr_id", "address_id", F.to_date("d").alias("effective_dt"))
    got = {(r["asset_hdr_id"], r["address_id"]): (r["update_current_address"], r["insert_asset_hdr_address"]) for r in status.address_changes(candidates, address).collect()}
    # 99 is among the addresses of the latest day (day 49 holds ids 49, 99, ...), 98 is not.
    assert got == {(HOT, 99): (0, 1), (HOT, 98): (1, 1), (4_999_999, 1): (1, 1)}


def test_as_of_with_a_hot_key(spark, small_partitions):
    """A third of the rows are of one key on a few days: whole, and dealt to many tasks."""
    days = "date_add(DATE '2024-01-01', CAST(id % 90 AS INT))"
    given = spark.range(ROWS).selectExpr("id", f"CASE WHEN id % 3 = 0 THEN {HOT} ELSE 1000 + id % 5000 END AS k", f"{days} AS d")
    versions = spark.range(40).selectExpr(f"CAST({HOT} AS BIGINT) AS k", "date_add(DATE '2024-01-01', CAST(id * 2 AS INT)) AS since", "id AS v")
    found = joins.as_of(given, versions, ["k"], "d", "since", "v", ["v"], range_days=30, part_rows=5_000)
    expected = f"CASE WHEN k = {HOT} THEN least(datediff(d, DATE '2024-01-01') DIV 2, 39) END"
    assert found.count() == ROWS and found.where(f"NOT v <=> {expected}").isEmpty()
    parts = found.where(f"k = {HOT}").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < ROWS / 3 / 2


def test_hierarchy_with_a_hot_root(spark, small_partitions):
    # Ids from 1, as 0 stands for none; a third of the nodes hang below 1.
    links = spark.range(1, 30_001).selectExpr("id", "CASE WHEN id % 3 = 1 THEN 1 WHEN id < 10 THEN 2 ELSE id DIV 10 END AS up")
    pairs = ancestor_pairs(links, "id", "up")
    parent = {i: 1 if i % 3 == 1 else (2 if i < 10 else i // 10) for i in range(1, 30_001)}
    expected = 0
    for node in parent:
        seen, at = {node}, parent[node]
        while at not in seen:
            expected += 1
            seen.add(at)
            at = parent[at]
    assert pairs.count() == expected
    assert pairs.where("root_id = 1").count() == sum(1 for i in parent if i != 1 and _reaches(parent, i))


def _reaches(parent, node):
    seen = set()
    while node not in seen:
        if node == 1:
            return True
        seen.add(node)
        node = parent[node]
    return False


def test_tax_of_a_hot_flow(spark, small_partitions):
    tax = hot(spark, "flow_id").withColumn("amt_tax", F.lit(1).cast("decimal(18,2)"))
    totals = ledger.tax_per_flow(tax)
    assert totals.where(f"flow_id = {HOT}").first()["total_tax"] == tax.where(f"flow_id = {HOT}").count()


def test_write_offs_of_a_hot_account(spark, small_partitions):
    write_off = hot(spark, "party_account_id").withColumn("amount", F.lit(2).cast("decimal(18,2)"))
    account = spark.range(5_000).select(F.col("id").alias("party_account_id"), F.col("id").alias("party_id"))
    party = spark.range(5_000).selectExpr("id AS party_id", "id AS party_no", "CAST(id AS STRING) AS name")
    got = listing.write_offs_by_party(write_off, account, party).where(f"party_no = {HOT}").first()
    n = write_off.where(f"party_account_id = {HOT}").count()
    assert (got["n_rows"], got["total_amount"]) == (n, 2 * n)


def test_used_definitions_of_a_hot_code(spark, small_partitions):
    definitions = spark.range(10_000).select(F.col("id").alias("lookupset_id"))
    instances = hot(spark, "code")
    assert listing.used_definitions(definitions, "lookupset_id", instances, "code").count() == instances.select("code").distinct().count()


def test_update_with_a_hot_foreign_key(spark, small_partitions):
    target = hot(spark, "k").withColumn("v", F.lit(0))
    marked = updates.set_for_keys(target, spark.createDataFrame([(HOT,)], "k long"), ["k"], {"v": 1})
    assert marked.count() == ROWS
    assert marked.where("v = 1").count() == target.where(f"k = {HOT}").count()


def test_few_rows_of_a_large_table_are_found_before_the_shuffle(spark):
    """A bitmap of hashes drops the rest; nulls, repeated rows, signs and keys of other types go through as in a semi join."""
    large = spark.range(200_000).selectExpr("id - 1000 AS a", "CAST(id % 7 AS INT) AS b", "id AS v")
    odd = spark.createDataFrame([(None, 1, -1), (5, None, -2), (5, 5, -3), (5, 5, -3)], "a long, b int, v long")
    rows = large.unionByName(odd)
    few = spark.createDataFrame([(5, 5), (-999, 1), (5, None), (None, 1), (7, 5), (5, 5)], "a long, b int")
    kept = joins.possible(rows, few, ["a", "b"]).count()
    assert 5 <= kept < 200
    for keys in (["a"], ["a", "b"]):
        assert sorted(r["v"] for r in joins.semi_few(rows, few, keys).collect()) == sorted(r["v"] for r in joins.semi(rows, few, keys).collect())
    found = joins.semi_few(rows, few, ["a", "b"], nulls_match=True)
    assert sorted(r["v"] for r in found.collect()) == [-3, -3, -2, -1, 1] and found.columns == rows.columns
    text = rows.selectExpr("CAST(a AS STRING) AS a", "v")
    assert joins.semi_few(text, few.selectExpr("CAST(a AS STRING) AS a"), ["a"]).count() == 6
    assert joins.semi_few(rows, few.limit(0), ["a"]).count() == 0


def test_a_release_finds_its_flows_once(spark):
    """The affected flows are stored once, and their tax summaries are found by that."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(flow_id):
        seen.add(1)
        return flow_id % 2 == 0

    flow = spark.range(10).selectExpr("id AS flow_id", *[f"CAST(1 AS DECIMAL(18,2)) AS {c}" for c in ledger.MATCHED])
    tax_flow = spark.range(20).selectExpr("id AS tax_flow_id", "id % 10 AS flow_id", "CAST(3 AS DECIMAL(18,2)) AS amt_matched")
    change = ledger.post_release(flow.where(counted("flow_id")), tax_flow).changes["tax_flow"]
    assert sorted(r["tax_flow_id"] for r in change.before.collect()) == list(range(0, 20, 2)) and seen.value == 10


def test_a_change_of_few_rows_does_not_shuffle_the_table(spark):
    """Rows that no update can meet go past the join; the rest as ever, with repeated and missing keys."""
    target = spark.range(100_000).selectExpr("id", "id AS v").unionByName(spark.createDataFrame([(None, 1), (7, 8), (7, 9)], "id long, v long"))
    updates = spark.createDataFrame([(7, 70), (8, None), (-1, 1), (None, 5)], "id long, v long")
    change = ChangeSet(["id"], target, updates=updates)
    once, twice = change.apply(target), change.apply(target, read_twice=True)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    touched, rest = joins.split_possible(target, updates, ["id"])
    assert touched.count() < 100 and touched.count() + rest.count() == target.count()


@pytest.mark.parametrize("shuffle_parts", ["1", "200"])
def test_a_sorted_listing_has_ranges_of_bounded_size(spark, shuffle_parts):
    """The rows are in order as by `orderBy`, and a task sorts `part_rows` of them, whatever the session's shuffle partitions."""
    rows = spark.range(40_000).selectExpr("IF(id % 100 = 3, NULL, id % 977) AS amount", "id * 7919 % 40009 AS entry")
    with conf(spark, **{"spark.sql.shuffle.partitions": shuffle_parts}):
        found = keys.sorted_rows(rows, ["amount", "entry"], part_rows=5_000)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in rows.orderBy("amount", "entry").collect()]
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 10_000
    assert keys.sorted_rows(rows.limit(0), ["amount"]).count() == 0
