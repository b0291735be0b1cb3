"""Conversation repair and the prefix trie against brute force and their SQL, on hostile fixtures."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest

from compare import duck_rows, spark_rows
from sparkledger.llm import prefix_trie, turn_repair
from sparkledger.llm.queries import ORACLES, QUERIES

# The columns clash with those that the operators make.
SCHEMA = "conv_id long, turn long, role string, text string, place string, copies string, audit string, key int, base string, _fault string"


def conversations() -> list[tuple]:
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "Bot", "tool", "", None])
            text = rng.choice(["Hi.", "Hi.", "what", "", " \n", "Why? yes", None, "Fine!\t\n", "über 😀 ok.", "a.b.c"])
            rows.append((conv, turn + rng.randrange(2), role, text))
    rows += [(r[0], r[1], r[2], r[3]) for r in rows[:12]]  # repeated rows
    rows += [(100, None, "user", "Hi."), (100, None, "user", "Hi."), (100, 4, "assistant", "Yes."), (120, 0, "user", "w " * 30_000 + ".")]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (-7, 0, "user", "Hi."), (-20, 3, "user", "Hi.")]
    rows += [(140 + i, t, ("user", "assistant")[t % 2], f"Shared {t}.") for i in range(25) for t in range(4 + i % 3)]
    rows += [(200, t, ("user", "assistant")[(t + t // 50) % 2], f"turn {t}" + "." * (t % 3)) for t in range(150)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("conversations"))
    df = spark.createDataFrame([(*r, "p", "c", "x", 1, "b", "f") for r in conversations()], SCHEMA)
    df.repartition(5).write.parquet(f"{out}/conversations.parquet")
    return out


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{out}/conversations.parquet")
    return out


def duck_of(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_prefix_trie"])
def test_hostile_rows_against_sql(spark, folder, empty_folder, name):
    assert spark_rows(QUERIES[name](spark, folder)) == duck_rows(duck_of(folder), ORACLES[name])
    assert QUERIES[name](spark, empty_folder).count() == 0


def cheapest(turns: list[tuple[str, bool, int]]) -> tuple[int, str]:
    """Of all edits of (initial, must go, more cost) turns, with at most two inserts at a place, the least cost and audit."""
    found = []

    def legal(roles: str) -> bool:
        body = roles[1:] if roles[:1] == "s" else roles
        return roles == "" or (len(body) > 0 and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))

    for edits in itertools.product("DKuai", repeat=0) if not turns else itertools.product(*(("D",) if gone else ("D", "K", "u", "a") for _, gone, _ in turns)):
        for inserts in itertools.product(["", "u", "a", "ua", "au"], repeat=len(turns) + 1):
            roles, audit, cost = "", "", 0
            for (initial, _, more), edit, before in zip(turns, edits, inserts):
                roles, audit, cost = roles + before, audit + "I" * len(before), cost + 5 * len(before)
                if edit == "D":
                    cost, audit = cost + 2, audit + "D"
                else:
                    roles += initial if edit == "K" else edit
                    cost, audit = cost + more + (edit != "K"), audit + ("K" if edit == "K" else "R")
            roles, audit, cost = roles + inserts[-1], audit + "I" * len(inserts[-1]), cost + 5 * len(inserts[-1])
            if legal(roles) and (" " not in roles):
                found.append((cost, audit))
    return min(found)


def test_repair_is_the_cheapest_of_all_edits():
    rng = random.Random(9)
    parser = turn_repair.Parser()
    for n in (0, 1, 2, 3, 4):
        for _ in range(25 if n < 4 else 4):
            turns = [(rng.choice(["u", "a", "s", "B", "P", "S", "$", " ", "x"]), rng.random() < 0.2, rng.choice([0, 0, 5])) for _ in range(n)]
            readings = parser.begin()
            for initial, gone, more in turns:
                readings = parser.set_aside(parser.step(readings, initial, gone, more))
                assert len(readings) <= 6  # equal stacks are merged
            named = [(i if i in "uas" else " ", gone, more) for i, gone, more in turns]
            assert parser.end(readings) == cheapest(named), turns


def test_grammars_that_need_more_than_one_symbol_ahead_are_refused():
    with pytest.raises(ValueError):
        turn_repair.Parser((("S", "A"), ("S", "B"), ("A", "u"), ("B", "u")))


def test_repaired_turns_are_legal_and_keep_texts(spark, folder):
    turns = turn_repair.numbered_turns(spark.read.parquet(f"{folder}/conversations.parquet"))
    audited = turn_repair.audits(turn_repair.judged_turns(turns))
    found: dict = {}
    for r in turn_repair.repaired_turns(turns, audited).collect():
        found.setdefault(r["conv_id"], []).append(r)
    given = {(r["conv_id"], r["text"]) for r in turns.collect()}
    assert len(found) > 50
    for conv, rows in found.items():
        rows.sort(key=lambda r: r["place"])
        assert [r["place"] for r in rows] == list(range(len(rows)))
        roles = "".join(r["role"][0] for r in rows)
        assert roles.lstrip("s") == "ua" * (len(rows) // 2) and roles.count("s") <= 1
        assert all((conv, r["text"]) in given for r in rows if r["edit"] != "I") and all(r["text"] == "" for r in rows if r["edit"] == "I")


def test_double_array_holds_exactly_its_paths():
    rng = random.Random(4)
    paths = [(i, [rng.randrange(1, 60) for _ in range(rng.randrange(1, 9))]) for i in range(400)]
    paths += [(1000, [5] * 3000), (1001, list(range(1, 2000)))]
    trie, ends = prefix_trie.pack_paths(paths)
    nodes = {}
    for name, ids in paths:
        node = 0
        for d, c in enumerate(ids, 1):
            node = trie.child(node, c)
            assert node > 0 and nodes.setdefault(node, tuple(ids[:d])) == tuple(ids[:d])
        assert ends[name] == (node, len(ids))
    assert len(nodes) == len({tuple(ids[:d]) for _, ids in paths for d in range(1, len(ids) + 1)}) == (trie.check[1:] >= 0).sum()
    assert trie.child(0, 61) == -1 and trie.child(ends[1000][0], 5) == -1


@pytest.mark.parametrize("shard_turns", [1, 7, 10**6])
def test_upper_nodes_and_shards_give_the_same_nodes(spark, folder, shard_turns):
    """Shards of one turn leave nearly all nodes, chains of hundreds included, to the upper part."""
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(turns), turns, shard_turns)
    assert spark_rows(found) == duck_rows(duck_of(folder), ORACLES["op13_prefix_trie"])


def test_a_third_of_all_conversations_are_equal(spark):
    rows = [(i, t, "user", f"same {t}") for i in range(300) for t in range(3)]
    rows += [(1000 + i, t, "user", f"own {i} {t}") for i in range(600) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, place long, role string, text string")
    found = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_trie(df, df, 50).collect()}
    assert len(found) == 1 + 3 + 600 * 3
    root, last = found[0, 0], found[0, 3]
    assert (root["n_convs"], root["n_children"], root["n_leaves"], root["parent_conv_id"]) == (900, 601, 601, None)
    assert (last["n_convs"], last["saved_tokens"]) == (300, 299 * 2) and root["saved_tokens"] == 3 * 299 * 2
    assert last["ends_sha256"] == hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()


def test_a_third_of_all_turns_are_of_one_conversation(spark):
    n = 9000
    rows = [(0, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(n)]
    rows += [(i, t, ("user", "assistant")[t % 2], "Yes.") for i in range(1, 2 * n // 10) for t in range(10)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in turn_repair.repair_digests(df, df).collect()}
    assert found[0]["audit"] == "K" * n and found[0]["cost"] == 0
    assert found[0]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows[:n]).encode()).hexdigest()
    # The first two turns stay, the eight that repeat them go.
    assert all(found[i]["audit"] == "KK" + "D" * 8 for i in range(1, 2 * n // 10))


def test_damage_follows_the_checksum(spark):
    rows = [(i, t, "assistant", "One. Two!") for i in range(40) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for i, t, role, text in rows:
        fault = zlib.crc32(f"{i}:{t}".encode()) % 20
        if fault:
            row = (i, t, "user" if fault == 4 else role, "" if fault == 1 else "One Two" if fault == 2 else text)
            expected += [row] * (2 if fault == 3 else 1)
    assert sorted(map(tuple, turn_repair.damaged(df).collect())) == sorted(expected)
