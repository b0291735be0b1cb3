"""Token ids in patched frame-of-reference blocks, written as pages in ascending document order and read back.

Format. A page holds the ids of whole documents, one after another, cut into blocks of `BLOCK_IDS` (the last may be
shorter). All numbers are little-endian.

    page     u32 number of ids, u32 number of blocks, u32 start of each block in bytes after this index, the blocks
    block    u32 minimum, u8 width in bits, u16 number of exceptions, packed values, exceptions
    packed   each id less the minimum, its lowest `width` bits, lowest bit first, filled up to a whole byte
    exception u16 place in the block, u32 id less the minimum; one for each value that does not fit the width

The width is that of the percentile `PERCENTILE` of the block's values, unless a wider one takes fewer bytes in all.
Pages are rows of a Parquet table (shard, page, start in the shard, document ids and lengths, payload), so that any
store that Spark writes to can hold them and lost tasks are written again. A second table has the start of each shard.

Defined results: null text is empty; each document ends with `end_id`, so that none is empty; rows that repeat an id
follow each other by the order of their ids' bytes, null ids come first; empty tables write and read no rows.
"""

from __future__ import annotations

import functools
import re
import struct
import sys
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from sparkledger.llm.common import arrow_schema, documents, in_batches, prepare, record_batch
from sparkledger.session import new_folder

BLOCK_IDS = 4096
PAGE_IDS = 1 << 18
PERCENTILE = 99
SHARD_BYTES = 32 << 20
BUCKETS = 100_000
# Pieces of text of either generation that a worker remembers.
REMEMBERED = 500_000


# The format --------------------------------------------------------------------------------------


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    values = (ids - low).astype(np.uint32)
    counts = np.bincount(_widths(values), minlength=33)
    above = len(values) - np.cumsum(counts)  # exceptions at each width
    least = int(np.searchsorted(np.cumsum(counts), np.ceil(len(values) * percentile / 100)))
    width = min(range(least, 33), key=lambda w: (len(values) * w + 7) // 8 + 6 * int(above[w]))
    places = np.flatnonzero(_widths(values) > width)
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    packed = np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()
    exceptions = np.zeros(len(places), np.dtype([("place", "<u2"), ("value", "<u4")]))
    exceptions["place"], exceptions["value"] = places, values[places]
    return struct.pack("<IBH", low, width, len(places)) + packed + exceptions.tobytes()


def unpack_block(data: bytes, n: int) -> np.ndarray:
    low, width, n_exceptions = struct.unpack_from("<IBH", data)
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, 7), bitorder="little", count=n * width)
    values = bits.reshape(n, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32)) if width else np.zeros(n, np.uint32)
    exceptions = np.frombuffer(data, np.dtype([("place", "<u2"), ("value", "<u4")]), n_exceptions, 7 + size)
    values = values.astype(np.uint32)
    values[exceptions["place"]] = exceptions["value"]
    return values + np.uint32(low)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; exact, as a double holds 53 bits."""
    return np.frexp(values.astype(np.float64))[1]


def pack_page(ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    blocks = [pack_block(ids[i : i + block]) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype("<u4")
    return struct.pack("<II", len(ids), len(blocks)) + starts.tobytes() + b"".join(blocks)


def unpack_page(data: bytes, block: int = BLOCK_IDS) -> np.ndarray:
    n, n_blocks = struct.unpack_from("<II", data)
    starts = np.frombuffer(data, "<u4", n_blocks, 8)
    base, view = 8 + 4 * n_blocks, memoryview(data)
    parts = [unpack_block(view[base + int(s) :], min(block, n - i * block)) for i, s in enumerate(starts)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# Encoding ----------------------------------------------------------------------------------------


def _byte_characters() -> dict[int, str]:
    """The character that byte-level models have for each byte: itself if it can be seen, else one after the first 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + n) for n, b in enumerate(rest)}}


class WordEncoder:
    """The tokenizer's ids for whole texts, with each distinct word encoded once for as long as it is remembered.

    The tokenizer drops white space, and none of its steps looks past it, so that a text's ids are those of the
    pieces between blanks and line ends. Pieces of printable ASCII and Latin letters need no normalising besides lower
    case, and split into words by a pattern. Strings of added tokens are cut out of the raw text before, as the library
    does; a tokenizer whose added tokens ask for more than that encodes whole texts itself.
    """

    # How the tokenizer splits lower-case ASCII and Latin letters.
    WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    BYTES = _byte_characters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        assert sys.byteorder == "little" and array("I").itemsize == 4
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.by_library = any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values())
        self.units = Remembered(self._unit)

    def _word(self, word: str) -> bytes:
        """Ids of a word in the model's characters."""
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if self.PLAIN.fullmatch(unit):
            words = self.WORDS.findall(unit.lower())
            if words == [unit]:  # a word is a unit too
                return self._word(unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.BYTES))
            return b"".join(map(self.units.__getitem__, words))
        normal = self.tokenizer.normalizer.normalize_str(unit)
        return b"".join([self._word(word) for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)])

    def encode(self, text: str) -> bytes:
        self.units.trim()
        if self.by_library:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not any(token in text for token in self.added):
            return self._ordinary(text)
        pieces = self.cuts.split(text)
        return b"".join([self.added[p] if k % 2 else self._ordinary(p) for k, p in enumerate(pieces)])

    def _ordinary(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, text.replace("\n", " ").split(" ")))


class Remembered(dict):
    """Values of a function. Once there are too many, those asked for least recently are forgotten."""

    def __init__(self, function):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One for each worker process, which serves many tasks."""
    return WordEncoder(path)


def encode_words(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", cuts: list | None = None
) -> DataFrame:
    """doc_id and `ids` (little-endian unsigned 32-bit integers) with the end id, and `shard`: how many of the cuts are not above the id."""
    prepare(docs.sparkSession)
    texts = documents(docs, id_col, text_col)
    schema = T.StructType([texts.schema["doc_id"], T.StructField("ids", T.BinaryType()), T.StructField("shard", T.IntegerType())])
    arrow = arrow_schema(schema)
    end = end_id.to_bytes(4, "little")
    cuts = cuts or []

    def encode(batches: Iterator[pa.RecordBatch]):
        encoder = word_encoder(tokenizer_path)

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    doc_id = doc_id.as_py()
                    shard = 0 if doc_id is None else bisect_right(cuts, doc_id)
                    yield doc_id, (encoder.encode(text.as_py()) if text.is_valid else b"") + end, shard

        return in_batches(rows(), arrow)

    return texts.mapInArrow(encode, schema)


# Writing and reading -------------------------------------------------------------------------------


def _cuts(docs: DataFrame, shard_bytes: int) -> list:
    """Ids that part the documents into shards of about as many bytes.

    Ids at even ranks part the documents into finer buckets first, whose bytes are then summed. At most `BUCKETS` buckets
    reach the driver, so that beyond `BUCKETS` * `shard_bytes` / 4 of text shards grow instead; a task sorts and reads its
    shard as a stream.
    """
    size = docs.select(F.sum(F.octet_length("text")).alias("size"), F.count("doc_id").alias("n")).first()
    n = -(-(size["size"] or 0) // shard_bytes)
    if n <= 1 or not size["n"]:
        return []
    buckets = min(4 * n, BUCKETS)
    ranks = docs.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], max(10_000, 4 * buckets))).first()[0]
    ranks = sorted(set(ranks))
    sized = docs.filter("doc_id IS NOT NULL").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("size", T.LongType())])
    arrow = arrow_schema(schema)

    def sums(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(len(ranks) + 1, np.int64)
        for batch in batches:
            places = [bisect_right(ranks, i) for i in batch.column(0).to_pylist()]
            total += np.bincount(places, batch.column(1).to_numpy(), len(total)).astype(np.int64)
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(total[places])], schema=arrow)

    found = dict(sized.mapInArrow(sums, schema).groupBy("bucket").agg(F.sum("size").alias("size")).toArrow().to_pandas().itertuples(index=False))
    cuts, held = [], 0
    for bucket, cut in enumerate(ranks):
        held += found.get(bucket, 0)
        if held + found.get(bucket + 1, 0) // 2 >= shard_bytes:
            cuts.append(cut)
            held = 0
    return cuts


def write_pages(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    page_ids: int = PAGE_IDS, shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode the texts and write their ids to `folder`/pages in ascending order of doc_id, and `folder`/shards."""
    spark = prepare(docs.sparkSession)
    cuts = _cuts(documents(docs, id_col, text_col), shard_bytes)
    encoded = encode_words(docs, tokenizer_path, end_id, id_col, text_col, cuts)
    dealt = encoded.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    id_type = encoded.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("page", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("payload", T.BinaryType()),
    ])
    arrow = arrow_schema(schema)

    def pages(batches: Iterator[pa.RecordBatch]):
        shard, page, start, ids, parts, weight = None, 0, 0, [], [], 0

        def made():
            flat = np.frombuffer(b"".join(parts), "<u4")
            return record_batch([(shard, page, start, list(ids), [len(p) // 4 for p in parts], pack_page(flat))], arrow)

        for batch in batches:
            for doc_id, data, at in zip(*(batch.column(n) for n in ("doc_id", "ids", "shard"))):
                if ids and (weight >= page_ids or at.as_py() != shard):
                    yield made()
                    page, start, ids, parts, weight = (page + 1, start + weight, [], [], 0) if at.as_py() == shard else (0, 0, [], [], 0)
                shard, data = at.as_py(), data.as_py()
                ids.append(doc_id.as_py())
                parts.append(data)
                weight += len(data) // 4
        if ids:
            yield made()

    dealt.mapInArrow(pages, schema).write.option("compression", "uncompressed").parquet(f"{folder}/pages")
    written = spark.read.schema(schema).parquet(f"{folder}/pages")
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    # One row for each shard: the only rows that the window sees.
    totals = written.groupBy("shard").agg(F.sum(length).alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")).alias("shard_start"), "n_ids")
    shards.write.parquet(f"{folder}/shards")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids, from the files that `write_pages` wrote."""
    prepare(spark)
    pages = spark.read.parquet(f"{folder}/pages")
    id_type = pages.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    arrow = arrow_schema(schema)

    def unpack(batches: Iterator[pa.RecordBatch]):
        def rows():
            for batch in batches:
                for shard, start, doc_ids, lengths, payload in zip(*(batch.column(n) for n in ("shard", "start", "doc_ids", "lengths", "payload"))):
                    data = unpack_page(payload.as_py()).astype("<u4").tobytes()
                    at, first = 0, start.as_py()
                    for doc_id, n in zip(doc_ids.as_py(), lengths.as_py()):
                        yield shard.as_py(), doc_id, first + at, data[4 * at : 4 * (at + n)]
                        at += n

        return in_batches(rows(), arrow)

    shards = spark.read.parquet(f"{folder}/shards").select("shard", "shard_start")
    found = pages.mapInArrow(unpack, schema).join(shards, "shard")
    return found.select("doc_id", (F.col("shard_start") + F.col("start")).alias("start"), "ids")


def page_digests(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, **options) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files read back."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-pages")
    write_pages(docs, folder, tokenizer_path, end_id, **options)
    read = read_pages(spark, folder)
    return read.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
