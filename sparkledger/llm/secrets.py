"""Secrets in texts: fixed patterns, and values in credential context that are costly to guess.

The cost of a value is found by dynamic programming: of all ways to cut it into words, dates, repeats, keyboard walks
or sequences and brute-force spans, the one with the fewest guesses counts. Values above `LEAST_LOG2` are reported as
kind `guess`, beside the spans of the patterns, unless one of those covers the whole value. Words are those of
`COMMON_WORDS` and, ranked after them, the whole words of a tokenizer's vocabulary, which are in order of their frequency.

The cost is the exact minimum wherever it is below `LEAST_LOG2`, for values of any length: every number of copies of a
repeat and every length of a walk counts. Repeats whose one period alone costs `LEAST_LOG2`, and walks that do, are left
out: they cannot lower a cost to below it. Values of under 6 characters are never judged, as even brute force costs less.

Positions are code points, ends exclusive. Defined results: null and empty texts have no spans; repeated rows and null
ids stay row by row; empty tables give no rows; other columns are ignored. Long values are judged whole.
"""

from __future__ import annotations

import functools
import json
import math
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sparkledger.llm.common import documents, prepare

KINDS = ("assign", "access", "hex", "guess")
LEAST_LOG2 = 36.0

# The base patterns, with the least length of what they find.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

# Names after which a value is a credential, for the guess cost; also as the end of a longer name.
CONTEXT = re.compile(
    r"""(?ai:(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?|bearer))["']?\s*[:=]+\s*(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"'<>,;]{6,}))"""
)

# Words that people choose, the commonest first.
COMMON_WORDS = """
password passwd admin letmein welcome monkey dragon master login princess football baseball shadow sunshine superman
michael iloveyou trustno whatever secret test guest root user default change changeme hello freedom ninja mustang
access flower hunter batman soccer charlie jordan thomas hockey ranger daniel george robert summer winter spring autumn
ashley jessica love pepper ginger cookie banana apple orange cheese coffee computer internet server system oracle
public private service example sample demo temp temporary token value here your this that with from none null true
false empty string enter insert replace placeholder redacted hidden unknown field data name word pass code text
the and for are you not all any can has was one our out day get him his how man new now old see two way who boy did
""".split()
KEYBOARD = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")
LEET = str.maketrans("430157$@", "aeoistsa")

_PLACE = {c: (row, col) for row, keys in enumerate(KEYBOARD) for col, c in enumerate(keys) if c != " "}
DATES = (
    re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"),
    re.compile(r"(?:19|20)\d\d"),
)


def _brute(char: str) -> float:
    if char.isdigit():
        return math.log2(10)
    return math.log2(26) if char.isalpha() else math.log2(33)


def _adjacent(a: str, b: str) -> bool:
    """Neighbouring keys, or neighbours in the alphabet or among the digits."""
    if abs(ord(a) - ord(b)) == 1 and a.isalnum() and b.isalnum():
        return True
    (r, c), (s, d) = _PLACE.get(a, (9, 9)), _PLACE.get(b, (99, 99))
    return abs(r - s) <= 1 and abs(c - d) <= 1 and a != b


def _walk_bits(length: int) -> float:
    return math.log2(47) + math.log2(length) + 2 + 0.5 * (length - 2)


class Starts:
    """Places where a span may start, for the cheapest one of each end; a span costs its start and log2 of its length.

    Ends only grow, and with them the lead of an earlier start over a later one, as the logarithm flattens. So the starts
    are a stack with the cheapest on top; it gives way for good to the one below it at the end where both cost the same.
    """

    def __init__(self):
        self.stack: list[tuple[int, float, float]] = []  # place, cost, and the end from which the one below is no dearer

    def add(self, place: int, cost: float, end: int) -> None:
        """A start later than all others; `end` is the first end that it serves."""
        self.least(end)
        meet = math.inf
        while self.stack:
            below, other, until = self.stack[-1]
            lead = cost - other
            meet = place + (place - below) / math.expm1(min(lead, 512.0) * math.log(2)) if lead > 0 else math.inf
            if meet <= end:
                return
            if meet < until:
                break
            self.stack.pop()
        self.stack.append((place, cost, meet if self.stack else math.inf))

    def least(self, end: int) -> float:
        """The least cost of a span to this end."""
        while len(self.stack) > 1 and self.stack[-1][2] <= end:
            self.stack.pop()
        return self.stack[-1][1] + math.log2(end - self.stack[-1][0]) if self.stack else math.inf


class Words(dict):
    """Ranks of lower-case words, and the length of the longest."""

    def __init__(self, words: list[str]):
        super().__init__()
        for word in words:
            self.setdefault(word, len(self) + 1)
        self.longest = max(map(len, self), default=0)


@functools.lru_cache(maxsize=2)
def ranked_words(path: str | None = None) -> Words:
    """The common words, and after them the whole words of at least three letters in a tokenizer file's vocabulary."""
    if path is None:
        return Words(COMMON_WORDS)
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    whole = (t.removesuffix("</w>") for t in sorted(vocabulary, key=vocabulary.get) if t.endswith("</w>"))
    return Words([*COMMON_WORDS, *(w for w in whole if len(w) >= 3 and w.isalpha() and w.islower())])


def guess_cost(value: str, words: Words | None = None, least_log2: float = LEAST_LOG2) -> float:
    """log2 of the guesses that the cheapest segmentation of the value takes; exact where it is below `least_log2`."""
    words = ranked_words() if words is None else words
    n, lower = len(value), value.lower()
    if len(lower) != n:
        lower = value
    plain = lower.translate(LEET)
    brute = [0.0, *accumulate(map(_brute, value))]
    walk = [1] * (n + 1)  # length of the walk that starts at each place
    for i in range(n - 2, -1, -1):
        if _adjacent(lower[i], lower[i + 1]):
            walk[i] = walk[i + 1] + 1
    # For each period, characters from each place that repeat those a period on; the cheapest characters set the longest.
    same = []
    for p in range(1, min(n // 3, int(least_log2 / math.log2(10))) + 1):
        run = [0] * (n + 1)
        for i in range(n - p - 1, -1, -1):
            run[i] = run[i + 1] + 1 if value[i] == value[i + p] else 0
        if max(run) >= 2 * p:
            same.append((p, run, {}))
    walks = []  # (length, cost)
    while len(walks) + 3 <= n and (bits := _walk_bits(len(walks) + 3)) < least_log2:
        walks.append((len(walks) + 3, bits))
    cost = [0.0] + [math.inf] * n
    for i in range(n + 1):
        # Repeats that end here: of three copies and more, by the place in the period where they start.
        for p, run, starts in same:
            if (first := i - 3 * p) >= 0 and run[first] >= 2 * p:
                if first == 0 or not run[first - 1]:
                    starts.clear()
                known = starts.setdefault(i % p, Starts())
                known.add(first, cost[first] + (1 if first else 0) + brute[first + p] - brute[first], i)
                cost[i] = min(cost[i], known.least(i))
        if i == n:
            break
        start = cost[i] + (1 if i else 0)

        def offer(end: int, bits: float) -> None:
            cost[end] = min(cost[end], start + bits)

        cost[i + 1] = min(cost[i + 1], cost[i] + brute[i + 1] - brute[i])
        for end in range(i + 3, min(n, i + words.longest) + 1):
            if (rank := words.get(lower[i:end])) is None and (rank := words.get(plain[i:end])) is not None:
                rank *= 4
            if rank:
                mixed = not (value[i:end].islower() or value[i + 1 : end].islower())
                offer(end, math.log2(rank) + 1 + mixed)
        for date in DATES:
            if (found := date.match(value, i)) is not None:
                offer(found.end(), math.log2(120 * (366 if found.end() - i > 4 else 1)))
        for length, bits in walks[: max(0, walk[i] - 2)]:
            offer(i + length, bits)
    return cost[n]


def find_spans(text: str, least_log2: float = LEAST_LOG2, words: Words | None = None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans, by start and then kind."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
        base = sorted((s, e) for s, _, e in found)
        at = reach = 0  # base spans that start by now, and the furthest end of these
        for match in CONTEXT.finditer(text):
            start, end = match.span(match.lastindex)
            while at < len(base) and base[at][0] <= start:
                reach = max(reach, base[at][1])
                at += 1
            if reach < end and guess_cost(text[start:end], words, least_log2) >= least_log2:
                found.append((start, 3, end))
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_log2: float = LEAST_LOG2, words_path: str | None = None
) -> DataFrame:
    """doc_id and `found`, an array of (kind, start, end). `words_path` is a tokenizer file whose vocabulary ranks words."""
    prepare(docs.sparkSession)
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(T.ArrayType(span))
    def scan(texts: pa.Array) -> pa.Array:
        words = ranked_words(words_path)
        spans = (find_spans(t, least_log2, words) if t else [] for t in texts.to_pylist())
        return pa.array([[{"kind": k, "start": s, "end": e} for s, k, e in row] for row in spans], arrow)

    return documents(docs, id_col, text_col).select("doc_id", scan("text").alias("found"))


def secret_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the count of each base kind, the digest of the base spans, and all spans as text."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    # Python finds the spans in order; a filter keeps it.
    found = scan_secrets(docs, **options)
    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *map(count, KINDS[:3]), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )
