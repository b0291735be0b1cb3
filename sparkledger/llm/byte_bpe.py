"""Byte-level BPE by recursive DuckDB queries in every partition.

Texts are split by the tokenizer's pattern. Each worker keeps the words it has met lately with their ids; the new words of
a few MB of text go to DuckDB as lists of tokens. A step of the recursive query turns them into rows (word, position,
token), joins neighbouring tokens with the merge table and contracts each word's leftmost pair of least rank, until no
word has a pair left. Decoding joins ids with the vocabulary and puts the pieces together by an ordered aggregation.

Words over `LONG_WORD` bytes go through a recursive query of their own, which contracts all places of the least pair in a
step, the leftmost first and without overlap. That is the same wherever the merged token makes no pair of lower rank than
its own; of the tokens that do (`alone` in the merge table) one place is contracted in a step. Steps are as many as the
pairs that differ, and each reads the word, so that words over `HEAP_WORD` bytes contract the same pairs in the same order
with a heap instead.

Defined results: null text is empty and has no ids; special tokens are ordinary text; repeated rows and null ids stay
as they are, row by row; empty tables give no rows; other columns are ignored. Ids that the vocabulary lacks fail.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from sparkledger.llm.common import arrow_schema, documents, prepare, serve

LONG_WORD = 1024
HEAP_WORD = 1 << 12
# Text that a task gathers before it asks DuckDB for the new words, and strings of either generation that a worker remembers.
GATHERED_CHARS = 4_000_000
REMEMBERED = 250_000
# Tokens that one recursive query may gather: a word has at most its length in tokens at each of as many steps.
QUERY_ROWS = 5_000_000
DECODED_AT_ONCE = 1_000_000
DUCKDB_MEMORY = "400MB"

# The characters that the pattern's \s stands for.
SPACE = r"[\t-\r \x85\xa0  -     　]"
NOT_SPACE = "[^" + SPACE[1:]

# A word's row of each step stays in the result; the one with the fewest tokens is the last.
CONTRACT = """
WITH RECURSIVE steps(word, toks) AS (
    SELECT word, toks FROM fresh
  UNION ALL
    SELECT s.word, list_concat(toks[:(best & 4294967295) - 1], [(best >> 32)::INT], toks[(best & 4294967295) + 2:])
    FROM steps s
    JOIN (
        SELECT word, min(merged::BIGINT << 32 | pos) AS best
        FROM (SELECT word, unnest(toks) AS tok, unnest(toks[2:]) AS following, unnest(range(1, len(toks))) AS pos FROM steps)
        JOIN merges ON pair = (tok::BIGINT << 32 | following)
        GROUP BY word
    ) b ON s.word = b.word
)
SELECT word, arg_min(toks, len(toks)) AS ids FROM steps GROUP BY word
"""

# Only the current row of a word is kept. Neighbouring places of the least pair overlap, and every second one counts.
CONTRACT_LONG = """
WITH RECURSIVE steps(word, toks) USING KEY (word) AS (
    SELECT word, toks FROM fresh
  UNION
    SELECT word, list(CASE WHEN starts THEN least >> 1 ELSE tok END::INT ORDER BY pos)
    FROM (
        SELECT word, pos, tok, least, starts, lag(starts, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone
        FROM (
            SELECT word, pos, tok, least, hit AND CASE WHEN least & 1 = 1 THEN pos = min(CASE WHEN hit THEN pos END) OVER (PARTITION BY word)
                   ELSE (pos - max(CASE WHEN hit THEN 0 ELSE pos END) OVER (PARTITION BY word ORDER BY pos)) % 2 = 1 END AS starts
            FROM (
                SELECT word, pos, tok, min(code) OVER (PARTITION BY word) AS least, coalesce(code = least, false) AS hit
                FROM (
                    SELECT word, pos, tok, merged * 2 + alone::INT AS code
                    FROM (SELECT word, unnest(toks) AS tok, unnest(toks[2:]) AS following, unnest(range(1, len(toks) + 1)) AS pos FROM steps)
                    LEFT JOIN merges ON pair = (tok::BIGINT << 32 | following)
                )
            ) WHERE least IS NOT NULL
        )
    ) WHERE NOT gone GROUP BY word
)
SELECT word, toks AS ids FROM steps
"""

# The rows are put in order before they are aggregated, by one thread, which keeps it.
DECODE = """
SELECT doc, string_agg(piece, '') AS pieces
FROM (SELECT doc, piece FROM tokens JOIN vocabulary USING (tok) ORDER BY doc, pos) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """A rank file with its DuckDB tables: `merges` (packed pair of ids, id of both together, `alone`) and `vocabulary`."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self.merge_of = dict(zip(pairs, merged))
        # Never a file: what does not fit fails. Texts are decoded in pieces, so that they do.
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""})
        above = {part for p, m in self.merge_of.items() for part in (p >> 32, p & 0xFFFFFFFF) if m < part}
        alone = pa.array([m in above for m in merged], pa.bool_())
        self.duck.register("given", pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32()), "alone": alone}))
        self.duck.execute("CREATE TABLE merges AS SELECT * FROM given")
        # A byte as the character of that number: DuckDB joins strings, and tokens may end within a character.
        tokens = {"tok": pa.array(self.ranks.values(), pa.int32()), "piece": [t.decode("latin-1") for t in self.ranks]}
        self.duck.register("given", pa.table(tokens))
        self.duck.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        # Words and units with their ids: those met of late, and those met before, which are forgotten next.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # Encoding ------------------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [units_of(text) for text in texts]
        fresh = {u: self.pattern.findall(u) for u in self._unknown(set().union(*split))}
        self._learn(self._unknown({w for words in fresh.values() for w in words}))
        known = self.known
        for unit, words in fresh.items():
            if len(words) > 1:  # one word is its unit
                known[unit] = b"".join([known[w] for w in words])
        out = [b"".join(map(known.__getitem__, units)) for units in split]
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return out

    def _unknown(self, strings: set[str]) -> list[str]:
        """Those that have to be learnt. What is met again counts as met of late."""
        known, older = self.known, self.older
        out = []
        for s in strings - known.keys():
            ids = older.get(s)
            if ids is None:
                out.append(s)
            else:
                known[s] = ids
        return out

    def rest(self) -> None:
        """Let go of the last tables."""
        for name in ("fresh", "tokens"):
            self.duck.unregister(name)

    def _learn(self, words: list[str]) -> None:
        held, rows = [], 0
        for word in words:
            data = word.encode()
            if (rank := self.ranks.get(data)) is not None:
                self.known[word] = rank.to_bytes(4, "little")
            elif len(data) > HEAP_WORD:
                self.known[word] = np.array(self.contract_long(data), "<u4").tobytes()
            elif len(data) > LONG_WORD:
                self._contract([(word, data)], CONTRACT_LONG)
            else:
                if rows + len(data) ** 2 > QUERY_ROWS and held:
                    self._contract(held)
                    held, rows = [], 0
                held.append((word, data))
                rows += len(data) ** 2
        if held:
            self._contract(held)

    def _contract(self, words: list[tuple[str, bytes]], query: str = CONTRACT) -> None:
        lengths = np.array([len(b) for _, b in words])
        tokens = self.byte_ids[np.frombuffer(b"".join(b for _, b in words), np.uint8)]
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        fresh = {"word": np.arange(len(words), dtype=np.int32), "toks": pa.ListArray.from_arrays(starts, pa.array(tokens))}
        self.duck.register("fresh", pa.table(fresh))
        found = self.duck.sql(query).to_arrow_table()
        ids = found["ids"].combine_chunks()
        flat, cuts = ids.flatten().to_numpy().astype("<u4").tobytes(), ids.offsets.to_numpy()
        base = int(cuts[0])
        for word, a, b in zip(found["word"].to_pylist(), cuts.tolist(), cuts[1:].tolist()):
            self.known[words[word][0]] = flat[4 * (a - base) : 4 * (b - base)]

    def contract_long(self, data: bytes) -> list[int]:
        """The same contraction with a heap of (rank, position), for long words."""
        tokens = self.byte_ids[np.frombuffer(data, np.uint8)].tolist()
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        end, heap = len(tokens), []

        def offer(i: int) -> None:
            j = after[i]
            if j < end and (rank := self.merge_of.get(tokens[i] << 32 | tokens[j])) is not None:
                heapq.heappush(heap, (rank, i, tokens[i], tokens[j]))

        for i in range(end - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if tokens[i] >= 0 else end
            if j >= end or tokens[i] != left or tokens[j] != right:
                continue  # one of them has gone into another token
            tokens[i], tokens[j] = rank, -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in tokens if t >= 0]

    # Decoding ------------------------------------------------------------------------------------

    def decode(self, ids: list[bytes]) -> list[bytes]:
        out = [b""] * len(ids)
        held, size = [], 0
        for doc, own in enumerate(ids):
            # Long documents in pieces: tokens decode one by one.
            for at in range(0, len(own), 4 * DECODED_AT_ONCE):
                piece = own[at : at + 4 * DECODED_AT_ONCE]
                if size + len(piece) > 4 * DECODED_AT_ONCE:
                    self._decode(held, out)
                    held, size = [], 0
                held.append((doc, piece))
                size += len(piece)
        self._decode(held, out)
        return out

    def _decode(self, pieces: list[tuple[int, bytes]], out: list[bytes]) -> None:
        lengths = np.array([len(i) // 4 for _, i in pieces], np.int64)
        tokens = np.frombuffer(b"".join(i for _, i in pieces), "<u4").astype(np.int32)
        doc = np.repeat(np.array([d for d, _ in pieces], np.int32), lengths)
        if len(tokens) and (tokens.min() < 0 or tokens.max() >= len(self.ranks)):
            raise ValueError("an id is not in the vocabulary")
        self.duck.register("tokens", pa.table({"doc": doc, "pos": np.arange(len(tokens), dtype=np.int64), "tok": tokens}))
        for doc, text in self.duck.execute(DECODE).fetchall():
            out[doc] += text.encode("latin-1")


_TWO_SPACES = re.compile(SPACE + "{2}")
_UNIT = re.compile(f"{SPACE}*{NOT_SPACE}+|{SPACE}+")


def units_of(text: str) -> list[str]:
    """Pieces of a text that the pattern splits independently of each other.

    No match of the pattern reaches over a place where white space follows other characters, so that a text can be
    cut there. Texts in which no two such characters meet, and none is at an end, need only be cut at blanks and line ends.
    """
    if not text:
        return []
    if _TWO_SPACES.search(text) or re.match(SPACE, text[0]) or re.match(SPACE, text[-1]):
        return _UNIT.findall(text)
    first, *rest = text.replace("\n", " \n").split(" ")
    return [first, *[p if p[0] == "\n" else " " + p for p in rest]]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for each worker process, which serves many tasks; kept until it serves another operator."""
    serve("byte_bpe", vocabulary.cache_clear)
    return Vocabulary(path, pattern)


def _gathered(batches: Iterable[pa.RecordBatch], weigh) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows in groups of about `GATHERED_CHARS`, so that memory does not depend on the length of the texts."""
    for batch in batches:
        start, weight, held = 0, 0, []
        for i, value in enumerate(batch.column(batch.num_columns - 1)):
            value = value.as_py()
            held.append(value)
            weight += weigh(value)
            if weight >= GATHERED_CHARS:
                yield batch.slice(start, len(held)), held
                start, weight, held = i + 1, 0, []
        if held:
            yield batch.slice(start, len(held)), held


def _mapped(df: DataFrame, value: str, outs: list[str], ranks_path: str, pattern: str, work, weigh) -> DataFrame:
    """`df` with column `value` replaced by the binary columns `outs`, computed for groups of rows."""
    others = [f for f in df.schema.fields if f.name != value]
    schema = T.StructType([*others, *(T.StructField(o, T.BinaryType()) for o in outs)])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        own = vocabulary(ranks_path, pattern)
        for rows, values in _gathered(batches, weigh):
            results = [pa.array(r, type=pa.binary()) for r in work(own, values)]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *results], schema=arrow)
        own.rest()

    return df.select(*(f.name for f in others), value).mapInArrow(run, schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    prepare(docs.sparkSession)
    return documents(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `ids`: the token ids of the whole text as little-endian unsigned 32-bit integers."""
    return _mapped(_texts(docs, id_col, text_col), "text", ["ids"], ranks_path, pattern, lambda v, texts: [v.encode(texts)], len)


def bpe_decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The frame with `ids_col` replaced by `decoded`, the bytes of the text."""
    prepare(encoded.sparkSession)
    return _mapped(encoded, ids_col, ["decoded"], ranks_path, pattern, lambda v, ids: [v.decode(ids)], lambda i: len(i) // 2)


def bpe_round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded, and on request its `ids`.

    Both in one Python step: two would take two workers for each core, either with a vocabulary of its own.
    """

    def both(own: Vocabulary, texts: list[str]) -> list[list[bytes]]:
        ids = own.encode(texts)
        return [ids, own.decode(ids)]

    done = _mapped(_texts(docs, id_col, text_col), "text", ["ids", "decoded"], ranks_path, pattern, both, len)
    return done.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids"] if with_ids else []),
    )
