"""Repeated passages between documents, by a de Bruijn graph over words.

Every run of `window` words is an edge from its first window - 1 words to its last ones. Only edges that may lie in
two documents are looked at: each has an anchor, the least hash of the `ANCHOR_WORDS`-word runs in it, and anchors are
counted first, with a partial count in each task; equal edges have equal anchors. A bitmap of the repeated anchors, of
`MOST_FILTER_BITS` bits at most, drops the edges of all others where the text is read; it only saves work, what it lets
through is compared all the same.

An edge's source is an occurrence in a document with a smaller id. Edges that follow each other in a document
and in their source alike form a nonbranching path, which is compacted to one span with the coordinates of its source.
Joins bring the texts of both ends of every span, and their words are compared by SHA-256, so that no span rests on
the edges' hashes alone; should one differ, the job fails and asks for another seed. `clean` gives the kept texts and
the spans as stored tables; `remove_repeats` gives digests of those texts.

Edges whose anchor occurs `HOT` times or more, in different places or documents, are dealt to several parts, and the earliest of each part meet again.

Defined results: null and empty texts have no words, and texts with fewer words than a window lose none; ids must be
integers, a null id is smaller than all others; documents that share an id are no sources for each other, and rows that
repeat id and text have a row each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sparkledger.llm.common import arrow_schema, bodies, in_batches, prepare, store

WINDOW = 13
ANCHOR_WORDS = 6
HOT = 1000
SALTS = 64
PLACE = ("doc_id", "text", "pos")
MOST_FILTER_BITS = 27
# Spans of one source document that one task compares.
SPANS_AT_ONCE = 1000
# Bytes of text that are hashed at once, and in one prefix sum; bytes of a word whose hash is a polynomial.
GROUP_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
PLAIN_BYTES = 64
# 0x20 and 0x09-0x0D separate words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWEST = -(1 << 63)
COLLISION = "two different passages have the same hash: run again with another seed"


class Edges:
    """Hashes of the edges and anchors of texts, for many texts at once.

    A word's hash is a polynomial of its bytes modulo 2^64, an edge's one of its words' hashes; both come from prefix sums,
    mixed afterwards. Words of more than `PLAIN_BYTES` bytes are hashed one by one: polynomials modulo 2^64 have collisions
    among long strings that hold for every seed.
    """

    def __init__(self, window: int, seed: int):
        self.window, self.size, self.seed = window, min(ANCHOR_WORDS, window), seed
        rng = np.random.default_rng(seed)
        self.of_byte = rng.integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
        self.factors = [int(x) | 1 for x in rng.integers(0, 1 << 64, 2, np.uint64)]
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.inverse = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _powers(self, kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n powers of a factor, and of its inverse."""
        if n > len(self.powers[kind]):
            for table, x in ((self.powers, self.factors[kind]), (self.inverse, pow(self.factors[kind], -1, 1 << 64))):
                each = np.full(max(n, 1 << 16), x, np.uint64)
                each[0] = 1
                table[kind] = np.cumprod(each)
        return self.powers[kind][:n], self.inverse[kind][:n]

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each word, a piece of the data at a time."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = int(starts[at])
            end = max(int(np.searchsorted(ends, low + PIECE_BYTES, "right")), at + 1)
            if end == at + 1 and ends[at] - low > PLAIN_BYTES:
                at = end
                continue
            powers, inverse = self._powers(0, int(ends[end - 1]) - low)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.of_byte[data[low : ends[end - 1]]] * powers)])
            out[at:end] = (sums[ends[at:end] - low] - sums[starts[at:end] - low]) * inverse[starts[at:end] - low]
            at = end
        out = _mixed(out)
        for i in np.flatnonzero(ends - starts > PLAIN_BYTES).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), self.seed)
        return out

    def _rolled(self, each: np.ndarray, size: int) -> np.ndarray:
        """The hash of every run of `size` words."""
        powers, inverse = self._powers(1, len(each))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each * powers)])
        return _mixed((sums[size:] - sums[:-size]) * inverse[: len(each) - size + 1])

    def of_all(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each window of each text, a text being the bytes between two bounds: text, place, edge, and anchor of 48 bits."""
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        if len(data) < 2 * self.window - 1:
            return none
        inside = ~SPACES[data]
        border = np.zeros(len(data) + 1, bool)
        border[bounds] = True
        starts = np.flatnonzero(inside & (border[:-1] | np.concatenate([[True], ~inside[:-1]])))
        ends = np.flatnonzero(inside & (border[1:] | np.concatenate([~inside[1:], [True]]))) + 1
        n = len(starts) - self.window + 1
        if n <= 0:
            return none
        text = np.searchsorted(bounds, starts, "right") - 1
        each = self._words(data, starts, ends)
        least = self._rolled(each, self.size) >> np.uint64(16)
        wanted, width = self.window - self.size + 1, 1
        while 2 * width <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[wanted - width : wanted - width + n])
        whole = np.flatnonzero(text[:n] == text[self.window - 1 :])
        place = whole - np.searchsorted(starts, bounds)[text[whole]]
        return text[whole], place, self._rolled(each, self.window)[whole], least[whole]

    def of(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each window of one text: its hash, and its anchor of 48 bits."""
        return self.of_all(np.frombuffer(body, np.uint8), np.array([0, len(body)]))[2:]

    def of_column(self, column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """`of_all` of a column of texts, for some MB of them at a time; texts are numbered as the column's rows."""
        large = pa.types.is_large_binary(column.type)
        bounds = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(column):
            end = max(int(np.searchsorted(bounds, bounds[at] + GROUP_BYTES, "right")) - 1, at + 1)
            text, *rest = self.of_all(data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at])
            yield text + at, *rest
            at = end


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(32))
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(29))


def _mapped(df: DataFrame, schema: T.StructType, rows) -> DataFrame:
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        return in_batches(rows(batches), arrow)

    return df.mapInArrow(run, schema)


def _anchors(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(anchor, doc_id) of the anchors of a document, once for each run of windows that have it."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("doc_id", T.LongType())])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        edges = Edges(window, seed)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for text, _, _, anchors in edges.of_column(batch.column("body")):
                if len(text):
                    # Neighbouring windows mostly have the same one.
                    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (anchors[1:] != anchors[:-1])]))
                    yield pa.RecordBatch.from_arrays([pa.array(anchors[new].view(np.int64)), pa.array(ids[text[new]])], schema=arrow)

    return docs.select("doc_id", "body").mapInArrow(run, schema)


def _bitmap(anchors: DataFrame, bits: int) -> np.ndarray:
    """A bit for each anchor, by its lowest bits; at most 2^bits / 64 rows reach the driver, whatever the corpus."""
    place = F.col("anchor").bitwiseAND((1 << bits) - 1)
    cells = anchors.groupBy(F.shiftright(place, 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(anchor & 63L as int))")).alias("value")
    ).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    return out.view(np.uint64)


def _in_bitmap(anchors: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    place = anchors & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _candidates(docs: DataFrame, window: int, seed: int, hot: int) -> DataFrame:
    """(edge, hot, doc_id, text, pos) of edges with a repeated anchor: the first place of each edge in a document. Stored."""
    counts = _anchors(docs, window, seed).groupBy("anchor").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    repeated = store(counts.filter("first < last").select("anchor", "n"), "repeats-anchors")
    n = repeated.count()
    bits = min(MOST_FILTER_BITS, max(16, (32 * n).bit_length()))
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(_bitmap(repeated, bits))
    frequent = spark.sparkContext.broadcast(_bitmap(repeated.filter(F.col("n") >= hot), bits))
    schema = T.StructType([
        T.StructField("edge", T.LongType()), T.StructField("hot", T.BooleanType()), T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.IntegerType()), T.StructField("pos", T.IntegerType()),
    ])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        edges = Edges(window, seed)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_numpy()
            for text, place, found, anchors in edges.of_column(batch.column("body")):
                chosen = np.flatnonzero(_in_bitmap(anchors, wanted.value))
                if not len(chosen):
                    continue
                order = chosen[np.lexsort((found[chosen], text[chosen]))]  # by text and edge, then by place
                first = np.concatenate([[True], (np.diff(text[order]) != 0) | (found[order][1:] != found[order][:-1])])
                own = order[first]
                columns = [
                    found[own].view(np.int64), _in_bitmap(anchors[own], frequent.value), ids[text[own]], texts[text[own]], place[own].astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    return store(docs.mapInArrow(run, schema), "repeats-edges")


def _sourced(edges: DataFrame) -> DataFrame:
    """Occurrences of edges with the coordinates of an earlier one, in a document with a smaller id.

    Frequent edges meet in `SALTS` parts, each of which finds the earliest occurrence it has; what is earliest in its
    part meets once more. Any earlier occurrence will do, so that no part waits for another.
    """
    salted = edges.withColumn("salt", F.when(F.col("hot"), F.pmod(F.hash("doc_id"), F.lit(SALTS))).otherwise(0))
    found = _earliest(salted, "edge", "salt").filter("doc_id > src_doc_id")
    first = _earliest(salted.filter("hot"), "edge", "salt").filter("not doc_id > src_doc_id").select("edge", *PLACE)
    return found.drop("edge", "salt", "hot").unionByName(_earliest(first, "edge").filter("doc_id > src_doc_id").drop("edge"))


def _earliest(rows: DataFrame, *keys: str) -> DataFrame:
    group = Window.partitionBy(*keys).orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({f"src_{c}": F.first(c).over(group) for c in PLACE})


def _spans(matched: DataFrame) -> DataFrame:
    """(doc_id, text, start, src_doc_id, src_text, src_start, n): paths of n edges."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.IntegerType()), T.StructField("start", T.IntegerType()),
        T.StructField("src_doc_id", T.LongType()), T.StructField("src_text", T.IntegerType()), T.StructField("src_start", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
    ])
    # Within a document; its edges come together as one list for each source and distance.
    paths = matched.groupBy("doc_id", "text", "src_doc_id", "src_text", (F.col("pos") - F.col("src_pos")).alias("ahead")).agg(
        F.collect_list("pos").alias("places")
    )

    def rows(batches):
        for batch in batches:
            for doc_id, text, src, src_text, ahead, places in zip(*(batch.column(i) for i in range(6))):
                places = np.unique(places.values.to_numpy())  # rows that repeat id and text have the same places
                cuts = np.flatnonzero(np.diff(places) != 1) + 1
                for run in np.split(places, cuts):
                    yield doc_id.as_py(), text.as_py(), int(run[0]), src.as_py(), src_text.as_py(), int(run[0]) - ahead.as_py(), len(run)

    return _mapped(paths, schema, rows)


def _read_back(docs: DataFrame, spans: DataFrame, window: int, seed: int) -> DataFrame:
    """The texts at both ends of the spans: digests of the spans' words, and what is kept of every document.

    Rows: (doc_id, text, start, n, source, digest) for spans, (doc_id, text, start, n, src_doc_id, src_text, src_start) for
    spans that come again in their own document, (doc_id, text, n_words, n_removed, kept) for documents.
    """
    source = ("src_doc_id", "src_text", "src_start")
    targets = spans.groupBy("doc_id", "text").agg(F.collect_list(F.struct("start", "n", *source)).alias("tasks"))
    targets = store(targets, "repeats-targets").hint("shuffle_hash")
    ends = spans.select(F.col("src_doc_id").alias("doc_id"), F.col("src_text").alias("text"), F.col("src_start").alias("start"), "n").distinct()
    # A source of many spans is dealt out in parts.
    parts = ends.groupBy("doc_id", "text").agg(F.ceil(F.count("*") / SPANS_AT_ONCE).alias("parts"))
    part = F.pmod(F.xxhash64("start", "n"), F.col("parts"))
    sources = ends.join(parts, ["doc_id", "text"]).groupBy("doc_id", "text", part.alias("part")).agg(F.collect_list(F.struct("start", "n")).alias("tasks"))
    sources = store(sources.drop("part"), "repeats-sources").filter(F.size("tasks") > 0).hint("shuffle_hash")
    long, int_, places = T.LongType(), T.IntegerType(), ("doc_id", "text", "start", "n")
    schema = T.StructType([
        *(T.StructField(c, long if c == "doc_id" else int_) for c in places),
        T.StructField("source", T.BooleanType()), T.StructField("digest", T.BinaryType()),
        *(T.StructField(c, long if c == "src_doc_id" else int_) for c in source),
        T.StructField("n_words", long), T.StructField("n_removed", long), T.StructField("kept", T.BinaryType()),
    ])
    nothing = (None,) * 3

    def digest(words, start, n):
        return hashlib.sha256(b" ".join(words[start : start + n + window - 1])).digest()

    def at_sources(batches):
        for batch in batches:
            for doc_id, text, body, todo in zip(*(batch.column(c) for c in ("doc_id", "text", "body", "tasks"))):
                words = body.as_py().split()
                for t in todo.as_py():
                    yield doc_id.as_py(), text.as_py(), t["start"], t["n"], True, digest(words, t["start"], t["n"]), *nothing, *nothing

    def at_targets(batches):
        edges = Edges(window, seed)
        for batch in batches:
            for doc_id, text, body, todo in zip(*(batch.column(c) for c in ("doc_id", "text", "body", "tasks"))):
                key, body, todo = (doc_id.as_py(), text.as_py()), body.as_py(), todo.as_py()
                words = body.split()
                if not todo:
                    yield *key, None, None, False, None, *nothing, len(words), 0, b" ".join(words)
                    continue
                for t in todo:
                    yield *key, t["start"], t["n"], False, digest(words, t["start"], t["n"]), *nothing, *nothing
                change = np.zeros(len(words) + 1, np.int64)
                for t in todo:
                    change[t["start"]] += 1
                    change[t["start"] + t["n"] + window - 1] -= 1
                for start, n, first, t in _again(edges.of(body)[0], todo):
                    if digest(words, start, n) != digest(words, first, n):
                        raise ValueError(COLLISION)
                    yield *key, start, n, False, None, t["src_doc_id"], t["src_text"], t["src_start"] + first - t["start"], *nothing
                    change[start] += 1
                    change[start + n + window - 1] -= 1
                covered = np.cumsum(change[:-1]) > 0
                kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
                yield *key, None, None, False, None, *nothing, len(words), int(covered.sum()), kept

    every = _mapped(docs.join(targets, ["doc_id", "text"], "left"), schema, at_targets)
    return every.unionByName(_mapped(docs.join(sources, ["doc_id", "text"]), schema, at_sources))


def _again(found: np.ndarray, todo: list[dict]) -> Iterator[tuple[int, int, int, dict]]:
    """(start, n, first, task): paths whose edges come from `first` on in a span of the same document."""
    own = np.concatenate([np.arange(t["start"], t["start"] + t["n"]) for t in todo])
    task = np.repeat(np.arange(len(todo)), [t["n"] for t in todo])
    order = np.argsort(found[own], kind="stable")
    own, task = own[order], task[order]
    other = np.ones(len(found), bool)
    other[own] = False
    places = np.flatnonzero(other & np.isin(found, found[own]))
    if not len(places):
        return
    at = np.searchsorted(found[own], found[places])
    first, task = own[at], task[at]
    cuts = np.flatnonzero((np.diff(places) != 1) | (np.diff(first) != 1) | (np.diff(task) != 0)) + 1
    for run in np.split(np.arange(len(places)), cuts):
        yield int(places[run[0]]), len(run), int(first[run[0]]), todo[task[run[0]]]


def _verify(spans: DataFrame, read: DataFrame) -> None:
    """Fail if a span's words differ from those of its source."""
    digests = read.filter("digest is not null")
    at = digests.filter("not source").select("doc_id", "text", "start", "n", F.col("digest").alias("own")).distinct()
    src = digests.filter("source").select(F.col("doc_id").alias("src_doc_id"), F.col("text").alias("src_text"), F.col("start").alias("src_start"), "n", F.col("digest").alias("theirs")).distinct()
    met = spans.join(at, ["doc_id", "text", "start", "n"], "left").join(src, ["src_doc_id", "src_text", "src_start", "n"], "left")
    if not met.filter(~F.coalesce(F.col("own") == F.col("theirs"), F.lit(False))).isEmpty():
        raise ValueError(COLLISION)


class Cleaned(NamedTuple):
    """What is kept of the documents, and the passages that were removed. Both are stored."""

    texts: DataFrame
    spans: DataFrame


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = 0, hot: int = HOT,
) -> Cleaned:
    """The documents less the passages that start in an earlier one, and these passages with their sources.

    `texts` has doc_id, n_words, n_removed and the kept text (its words with single blanks between them) of every
    document. `spans` has doc_id, start, n_words, src_doc_id and src_start of every removed passage, in words, with the
    hashes of both texts (text_hash, src_text_hash) to tell documents apart that share an id; passages may overlap.
    """
    prepare(docs.sparkSession)
    given = bodies(docs, id_col, text_col)
    # The place of a null id in the order; documents that share an id differ in `text`.
    keyed = given.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc_id"), F.hash("body").alias("text"), "body"
    )
    spans = store(_spans(_sourced(_candidates(keyed, window, seed, hot))), "repeats-spans")
    read = store(_read_back(keyed, spans, window, seed), "repeats-read")
    _verify(spans, read)

    def own(column: str) -> Column:
        return F.when(F.col(column) != LOWEST, F.col(column)).cast(given.schema["doc_id"].dataType).alias(column)

    again = read.filter("src_doc_id is not null").select(spans.columns).distinct()
    return Cleaned(
        read.filter("kept is not null").select(own("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("text")),
        spans.unionByName(again).select(
            own("doc_id"), F.col("text").alias("text_hash"), "start", (F.col("n") + window - 1).alias("n_words"),
            own("src_doc_id"), F.col("src_text").alias("src_text_hash"), "src_start",
        ),
    )


def removed_spans(docs: DataFrame, **options) -> DataFrame:
    """The removed passages of all documents with their sources, after both ends were compared."""
    return clean(docs, **options).spans


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document, from the kept texts as they were stored."""
    return clean(docs, **options).texts.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
