"""Conversation structure repair: generalised LR parsing of role sequences with weighted edits.

Each conversation's turns, in order, are parsed against a grammar of role initials while every turn may be kept, given
another role or deleted, and turns may be inserted. The parser is an LR automaton built from the grammar. Its stacks are
shared (a stack is a state on top of another stack, and equal stacks are one object), so that all readings of the turns
so far form a graph. Readings that lead to the same stack are merged: the least (cost, audit) stays. The audit has one
letter for each edit: D(elete), I(nsert), K(eep), R(erole); each turn adds some I and then one other letter, so that
comparing audits up to a turn compares whole ones.

`audits` streams the turns of a conversation in order and gives one row for it; `repaired_turns` streams them again next
to the audit and gives the repaired turns. Neither holds a conversation's texts: what is kept of it is the audit (one
letter a turn, as the result has it) for each of a handful of stacks. One task reads one conversation from its sorted
shuffle, since a parse is sequential; whether a turn was seen earlier is found before, by an aggregate that tasks reduce.

Defined results: turns come by turn number, nulls first, then by role and text; null roles and texts are one space;
repeated rows are turns like others; rows of a null id are one conversation; a turn without letters in its role can only
be given another role or deleted; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkledger.llm.common import arrow_schema, in_batches, prepare, store

# What counts as white space and as the end of a sentence, and the cost of each edit.
SPACES = " \t\n\x0b\f\r"
SENTENCE_ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL_NEIGHBOURS = {"su", "ua", "au"}
# (s?(ua)+)? : an empty conversation, or pairs of user and assistant after at most one system turn.
GRAMMAR = (("S", ""), ("S", "B"), ("B", "sP"), ("B", "P"), ("B", "BP"), ("P", "ua"))

# Turns after which the letters of an audit so far are set aside, so that adding one does not copy all.
BLOCK = 4096


# The parser ------------------------------------------------------------------------------------------


class Automaton:
    """SLR tables of a small grammar: (left, right) productions of one-letter symbols, the first left is the start."""

    def __init__(self, productions: tuple[tuple[str, str], ...]):
        self.productions = productions
        lefts = {left for left, _ in productions}
        start = productions[0][0]
        self.terminals = {symbol for _, right in productions for symbol in right} - lefts
        first = self._closure_of_sets(lefts, lambda left, right, sets: self._first(right, lefts, sets))
        follow = {left: set() for left in lefts}
        follow[start].add("$")
        changed = True
        while changed:
            changed = False
            for left, right in productions:
                for i, symbol in enumerate(right):
                    if symbol in lefts:
                        ahead = self._first(right[i + 1 :], lefts, first)
                        new = (ahead - {""}) | (follow[left] if "" in ahead else set())
                        changed |= not new <= follow[symbol]
                        follow[symbol] |= new
        self.states: list[frozenset] = []
        numbers: dict[frozenset, int] = {}
        self.goto: dict[tuple[int, str], int] = {}
        self.reduce: dict[tuple[int, str], tuple[str, int]] = {}
        self.complete: dict[int, tuple[str, int]] = {}  # states that are reduced whatever comes

        def number(items: frozenset) -> int:
            if items not in numbers:
                numbers[items] = len(self.states)
                self.states.append(items)
            return numbers[items]

        number(self._items({(left, right, 0) for left, right in productions if left == start}, lefts))
        for state, items in enumerate(self.states):  # grows while it is read
            for symbol in sorted({right[at] for _, right, at in items if at < len(right)}):
                moved = {(left, right, at + 1) for left, right, at in items if right[at : at + 1] == symbol}
                self.goto[state, symbol] = number(self._items(moved, lefts))
            for left, right, at in items:
                if at == len(right):
                    if len(items) == 1 and left != start:
                        self.complete[state] = (left, len(right))
                    for ahead in follow[left]:
                        if (state, ahead) in self.reduce or ahead in lefts:
                            raise ValueError("the grammar needs more than one symbol ahead")
                        self.reduce[state, ahead] = (left, len(right))
        self.start = start

    def _closure_of_sets(self, lefts, step):
        sets = {left: set() for left in lefts}
        changed = True
        while changed:
            changed = False
            for left, right in self.productions:
                new = step(left, right, sets)
                changed |= not new <= sets[left]
                sets[left] |= new
        return sets

    @staticmethod
    def _first(symbols, lefts, sets) -> set:
        out = set()
        for symbol in symbols:
            own = sets[symbol] if symbol in lefts else {symbol}
            out |= own - {""}
            if "" not in own:
                return out
        return out | {""}

    def _items(self, items: set, lefts) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            _, right, at = todo.pop()
            if at < len(right) and right[at] in lefts:
                for left, other in self.productions:
                    if left == right[at] and (left, other, 0) not in items:
                        items.add((left, other, 0))
                        todo.append((left, other, 0))
        return frozenset(items)


class Stack:
    """A state on top of another stack. Equal stacks are one object, so that readings share and merge them."""

    __slots__ = ("state", "below", "above", "shifts")

    def __init__(self, state: int, below: Stack | None):
        self.state, self.below = state, below
        self.above: dict[int, Stack] = {}
        self.shifts: dict[str, Stack | None] = {}

    def push(self, state: int) -> Stack:
        if state not in self.above:
            self.above[state] = Stack(state, self)
        return self.above[state]


class Parser:
    """The graph-structured stack over an automaton."""

    def __init__(self, productions=GRAMMAR):
        self.automaton = Automaton(productions)
        self.bottom = Stack(0, None)
        self.accepts: dict[Stack, bool] = {}

    def _reduced(self, stack: Stack, ahead: str) -> Stack | None:
        while (found := self.automaton.reduce.get((stack.state, ahead))) is not None:
            left, size = found
            for _ in range(size):
                stack = stack.below
            if left == self.automaton.start:
                return None if ahead != "$" else stack
            stack = stack.push(self.automaton.goto[stack.state, left])
        return stack

    def _completed(self, stack: Stack) -> Stack:
        """The stack with every reduction that does not depend on what follows, so that readings merge at once."""
        while (found := self.automaton.complete.get(stack.state)) is not None:
            left, size = found
            for _ in range(size):
                stack = stack.below
            stack = stack.push(self.automaton.goto[stack.state, left])
        return stack

    def shift(self, stack: Stack, symbol: str) -> Stack | None:
        """The stack after a symbol, or None where the grammar has none there."""
        if symbol not in stack.shifts:
            top = self._reduced(stack, symbol) if symbol in self.automaton.terminals else None
            state = None if top is None else self.automaton.goto.get((top.state, symbol))
            stack.shifts[symbol] = None if state is None else self._completed(top.push(state))
        return stack.shifts[symbol]

    def accepted(self, stack: Stack) -> bool:
        if stack not in self.accepts:
            self.accepts[stack] = self._reduced(stack, "$") is self.bottom and (stack.state, "$") in self.automaton.reduce
        return self.accepts[stack]

    def with_inserts(self, readings: dict) -> dict:
        """The readings and those that insert turns after them; each insert costs, so that this ends."""
        todo = list(readings.items())
        while todo:
            stack, (cost, done, tail) = todo.pop()
            if readings.get(stack) != (cost, done, tail):
                continue
            for symbol in ROLES:
                after = self.shift(stack, symbol)
                if after is not None and self._better(readings, after, (cost + INSERT, done, tail + "I")):
                    todo.append((after, readings[after]))
        return readings

    @staticmethod
    def _better(readings: dict, stack: Stack, value: tuple) -> bool:
        if stack in readings and readings[stack] <= value:
            return False
        readings[stack] = value
        return True

    def begin(self) -> dict:
        """Readings of no turns: stack to (cost, audit in whole blocks, audit since)."""
        return {self.bottom: (0, (), "")}

    def step(self, readings: dict, symbol: str, must_go: bool, more: int) -> dict:
        """Readings after one more turn of role initial `symbol`; `more` is what it costs if it is not deleted."""
        out: dict = {}
        for stack, (cost, done, tail) in self.with_inserts(readings).items():
            self._better(out, stack, (cost + DELETE, done, tail + "D"))
            if must_go:
                continue
            kept = self.shift(stack, symbol) if symbol else None
            if kept is not None:
                self._better(out, kept, (cost + more, done, tail + "K"))
            for other in ROLES:
                after = self.shift(stack, other)
                if after is not None:
                    self._better(out, after, (cost + REROLE + more, done, tail + "R"))
        return out

    @staticmethod
    def set_aside(readings: dict) -> dict:
        """The same readings with their letters so far in a block. All get one at the same turn, so that blocks compare as audits do."""
        return {stack: (cost, (*done, tail), "") for stack, (cost, done, tail) in readings.items()}

    def end(self, readings: dict) -> tuple[int, str]:
        """Cost and audit of the cheapest reading that the grammar accepts."""
        whole = {s: v for s, v in self.with_inserts(readings).items() if self.accepted(s)}
        cost, done, tail = min(whole.values())
        return cost, "".join(done) + tail


# Faults ----------------------------------------------------------------------------------------------


def numbered_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, text of every turn with `copies`, how often that very row occurs."""
    filled = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text")))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), *filled)
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))


def _row_key() -> Column:
    """Of a conversation's role and text; lengths keep them apart."""
    return F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256)


def judged_turns(numbered: DataFrame) -> DataFrame:
    """`numbered_turns` with `blank`, `truncated` and `seen` (role and text occur at an earlier turn)."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = numbered.select(
        "*", (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(*SENTENCE_ENDS)).alias("truncated"),
        F.xxhash64("conv_id").alias("conv_key"), _row_key().alias("row_key"),
    )
    rows = store(rows, "judged-turns")
    # Only rows that occur at several turns need to know the first one.
    first = rows.groupBy("conv_key", "conv_id", "row_key").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")).alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select("conv_key", F.col("conv_id").alias("of"), "row_key", "first")
    same = (rows["conv_key"] == first["conv_key"]) & (rows["row_key"] == first["row_key"]) & rows["conv_id"].eqNullSafe(first["of"])
    found = rows.join(first, same, "left")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return found.select("conv_id", "turn", "role", "text", "copies", "blank", "truncated", later.alias("seen"))


ORDER = (F.asc_nulls_first, ("conv_id", "turn")), (F.asc, ("role", "text"))


def _in_order(rows: DataFrame, *first: Column) -> DataFrame:
    """All rows of a conversation side by side in one partition, by turn."""
    conv, *rest = [way(name) for way, names in ORDER for name in names]
    return rows.repartition("conv_id").sortWithinPartitions(conv, *first, *rest)


# The operator ----------------------------------------------------------------------------------------


def audits(judged: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit."""
    prepare(judged.sparkSession)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([judged.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in counts), T.StructField("audit", T.StringType())])
    arrow = arrow_schema(schema)
    fields = ("conv_id", "turn", "role", "copies", "blank", "truncated", "seen")

    def parse(batches: Iterator[pa.RecordBatch]):
        parser = Parser()

        def rows():
            open_id, any_open = None, False

            def made():
                cost, audit = parser.end(readings)
                gaps = 0 if last is None else high - low + 1 - distinct
                return open_id, gaps, n_blank, n_duplicate, n_truncated, illegal, cost, audit

            for batch in batches:
                for conv, turn, role, copies, blank, truncated, seen in zip(*(c.to_pylist() for c in batch.columns)):
                    if not any_open or conv != open_id:
                        if any_open:
                            yield made()
                        open_id, any_open = conv, True
                        low = high = last = None
                        distinct = n_blank = n_duplicate = n_truncated = illegal = n = 0
                        initial, readings = None, parser.begin()
                    if turn is not None and (last is None or turn != last):
                        low, high, last, distinct = (turn if low is None else low), turn, turn, distinct + 1
                    for copy in range(copies):
                        duplicate = not blank and (seen or copy > 0)
                        cut = truncated and not blank and not duplicate
                        n_blank, n_duplicate, n_truncated = n_blank + blank, n_duplicate + duplicate, n_truncated + cut
                        illegal += initial is not None and initial + role[:1] not in LEGAL_NEIGHBOURS
                        initial = role[:1]
                        readings = parser.step(readings, initial, blank or duplicate, TRUNCATED if cut else 0)
                        n += 1
                        if n % BLOCK == 0:
                            readings = parser.set_aside(readings)

            if any_open:
                yield made()

        return in_batches(rows(), arrow)

    return _in_order(judged).select(*fields).mapInArrow(parse, schema)


def repaired_turns(numbered: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of the turns that stay or are inserted, in order within each conversation's partition."""
    prepare(numbered.sparkSession)
    heads = audited.select(
        "conv_id", F.lit(None).cast(numbered.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(0).cast("long").alias("copies"), "audit",
    )
    both = numbered.select("conv_id", "turn", "role", "text", "copies", F.lit(None).cast("string").alias("audit")).unionByName(heads)
    schema = T.StructType([
        numbered.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    arrow = arrow_schema(schema)

    def apply(batches: Iterator[pa.RecordBatch]):
        def rows():
            audit, at, place, system, body = "", 0, 0, False, 0

            def due() -> str:
                """The role that the grammar asks for at this place."""
                return "user" if (place - system) % 2 == 0 else "assistant"

            for batch in batches:
                for conv, _, role, text, copies, edits in zip(*(c.to_pylist() for c in batch.columns)):
                    if edits is not None:
                        audit, at, place, system, body = edits, 0, 0, False, len(edits.rstrip("I"))
                    for _ in range(copies):
                        while audit[at] == "I":
                            yield conv, place, "I", due(), ""
                            at, place = at + 1, place + 1
                        edit, at = audit[at], at + 1
                        if edit != "D":
                            system |= place == 0 and edit == "K" and role[:1] == "s"
                            yield conv, place, edit, role if edit == "K" else due(), text
                            place += 1
                    while body <= at < len(audit):  # inserts after the last turn
                        yield conv, place, "I", due(), ""
                        at, place = at + 1, place + 1

        return in_batches(rows(), arrow)

    return _in_order(both, F.asc(F.col("audit").isNull())).mapInArrow(apply, schema)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of `repaired_turns`, whose order it uses: `role:text`, joined by line ends."""
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    arrow = arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]):
        def rows():
            open_id, sha = None, None
            for batch in batches:
                for conv, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if place == 0:
                        if sha is not None:
                            yield open_id, sha.hexdigest()
                        open_id, sha = conv, hashlib.sha256()
                    else:
                        sha.update(b"\n")
                    sha.update(f"{role}:{text}".encode())
            if sha is not None:
                yield open_id, sha.hexdigest()

        return in_batches(rows(), arrow)

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(digest, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with the faults of the query's contract, by the checksum of `conv_id:turn` (null: one space)."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20).alias("_fault"),
    )
    return rows.filter("_fault <> 0").select(
        "conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def repair_digests(turns: DataFrame, original: DataFrame) -> DataFrame:
    """The audit of each conversation and the digest of its repaired turns, one row for each conv_id of `original`."""
    numbered = numbered_turns(turns)
    audited = store(audits(judged_turns(numbered)), "audits")
    digests = repaired_digests(repaired_turns(numbered, audited))
    empty = hashlib.sha256().hexdigest()
    # One aggregate in place of outer joins: null ids are one group, and an id that only `original` has gets the defaults.
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = audited.unionByName(digests, allowMissingColumns=True)
    parts = parts.unionByName(original.select("conv_id").distinct(), allowMissingColumns=True)
    return parts.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )
