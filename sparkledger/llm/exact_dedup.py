"""Exact duplicates by composable polynomial fingerprints, confirmed by comparing the texts chunk by chunk.

The fingerprint of a text is the polynomial with its bytes as coefficients, at 256, modulo a prime. Pieces are
hashed wherever they lie: fp(ab) = fp(a) * 256^len(b) + fp(b). A text of more than one segment is dealt out, so
that many tasks hash one huge document. Rows with the same fingerprint and length are then compared with one
member of their group, in chunks that meet in a join; what differs forms a group of its own and is compared again.

Defined results: null text counts as empty; empty texts equal each other; rows that repeat both id and text are
rows like others; a null id is an id like others, smaller than all; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sparkledger.llm.common import arrow_schema, bodies, in_batches, key_of, prepare, serve, store

# A safe prime just above 2^126 (both it and (p - 1) / 2 are prime), so that powers of 256 do not repeat.
MODULUS = 85070591730234615865843651857942053687
SEGMENT_BYTES = 1 << 20
CHUNK_BYTES = 1 << 16
COPIES_AT_ONCE = 100_000


def fingerprint(data: bytes, modulus: int = MODULUS) -> int:
    """The polynomial of a piece; pieces of 4 KB keep the division linear in the length."""
    value = 0
    for i in range(0, len(data), 4096):
        piece = data[i : i + 4096]
        value = combine(value, int.from_bytes(piece, "big") % modulus, len(piece), modulus)
    return value


def combine(left: int, right: int, right_bytes: int, modulus: int = MODULUS) -> int:
    """The fingerprint of two pieces together: the left one is shifted by the length of the right one."""
    return (left * pow(256, right_bytes, modulus) + right) % modulus


def _packed(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _segments(docs: DataFrame, segment: int, modulus: int) -> DataFrame:
    """One row per segment. Those of one-segment texts are hashed where they are; others carry their bytes to another task."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_sha256", T.StringType()), T.StructField("part", T.IntegerType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("piece", T.BinaryType()),
    ])
    arrow = arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]):
        serve("exact_dedup")

        def rows():
            for batch in batches:
                for doc_id, body in zip(batch.column(0), batch.column(1)):
                    doc_id, body = doc_id.as_py(), body.as_py().lower()
                    digest = hashlib.sha256(body).hexdigest()
                    if len(body) <= segment:
                        yield doc_id, digest, 0, len(body), _packed(fingerprint(body, modulus)), None
                        continue
                    for part, i in enumerate(range(0, len(body), segment)):
                        piece = body[i : i + segment]
                        yield doc_id, digest, part, len(piece), None, piece

        return in_batches(rows(), arrow)

    def hash_pieces(batches: Iterator[pa.RecordBatch]):
        serve("exact_dedup")
        for batch in batches:
            pieces, known = batch.column("piece"), batch.column("fp")
            values = [_packed(fingerprint(p.as_py(), modulus)) if p.is_valid else k.as_py() for p, k in zip(pieces, known)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(values, pa.binary())], schema=pa.schema(list(arrow)[:5]))

    dealt = docs.mapInArrow(cut, schema).repartition("doc_id", "part")
    return dealt.mapInArrow(hash_pieces, T.StructType(schema.fields[:5]))


def fingerprints(docs: DataFrame, segment: int = SEGMENT_BYTES, modulus: int = MODULUS) -> DataFrame:
    """doc_id, text_sha256, fp, n_bytes of the lower-cased (A-Z) text and `copies`, how many rows repeat both, from frames of doc_id and body."""

    @F.arrow_udf(T.BinaryType())
    def joined(parts: pa.Array) -> pa.Array:
        serve("exact_dedup")

        def whole(row):
            value = 0
            for part in sorted(row, key=lambda p: p["part"]):
                value = combine(value, int.from_bytes(part["fp"], "big"), part["n_bytes"], modulus)
            return _packed(value)

        return pa.array([whole(row) for row in parts.to_pylist()], pa.binary())

    # collect_set: rows that repeat id and text give the same parts. A document has one entry for each segment.
    parts = _segments(docs, segment, modulus).groupBy("doc_id", "text_sha256").agg(
        F.collect_set(F.struct("part", "n_bytes", "fp")).alias("parts"), F.count_if(F.col("part") == 0).alias("copies")
    )
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["n_bytes"])
    one = F.size("parts") == 1
    return parts.select(
        "doc_id", "text_sha256", F.when(one, F.col("parts")[0]["fp"]).otherwise(joined("parts")).alias("fp"), total.alias("n_bytes"), "copies"
    )


def _chunks(docs: DataFrame, chosen: DataFrame, chunk: int) -> DataFrame:
    """The chunks of the chosen documents' texts, with the other columns of `chosen`."""
    extra = [f for f in chosen.schema.fields if f.name not in ("doc_id", "text_sha256")]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_sha256", T.StringType()), *extra, T.StructField("chunk", T.IntegerType()), T.StructField("data", T.BinaryType())])
    arrow = arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]):
        serve("exact_dedup")

        def rows():
            for batch in batches:
                bodies_, names = batch.column("body"), batch.schema.names
                rest = [batch.column(n).to_pylist() for n in names if n != "body"]
                for body, *row in zip(bodies_, *rest):
                    body = body.as_py().lower()
                    if hashlib.sha256(body).hexdigest() != row[1]:
                        continue  # another text under the same id
                    for number, i in enumerate(range(0, max(len(body), 1), chunk)):
                        yield *row, number, body[i : i + chunk]

        return in_batches(rows(), arrow)

    left = docs.withColumn("_key", key_of())
    right = chosen.withColumnRenamed("doc_id", "_id").withColumn("_right", key_of("_id")).hint("shuffle_hash")
    met = left.join(right, (F.col("_key") == F.col("_right")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return met.select("doc_id", "text_sha256", *(f.name for f in extra), "body").mapInArrow(cut, schema)


def _compare(docs: DataFrame, members: DataFrame, chunk: int) -> DataFrame:
    """Members of groups of several rows, each with `same`: its text equals that of the group's representative."""
    pieces = _chunks(docs, members.select("doc_id", "text_sha256", "fp", "n_bytes", "is_rep"), chunk)
    pieces = pieces.select("doc_id", "text_sha256", "fp", "n_bytes", "is_rep", "chunk", "data")
    stored = store(pieces, "dedup-chunks")
    # A row for each chunk of a representative: repeated input rows must not repeat it. Stored, so that adaptive
    # execution sees a plain join and can split the members of a hot group.
    reps = store(stored.filter("is_rep").groupBy("fp", "n_bytes", "chunk").agg(F.first("data").alias("rep_data")), "dedup-reps")
    joined = stored.filter("not is_rep").join(reps, ["fp", "n_bytes", "chunk"], "left")
    equal = F.coalesce(F.col("data") == F.col("rep_data"), F.lit(False))
    return joined.groupBy("doc_id", "text_sha256", "fp", "n_bytes").agg(F.min(equal).alias("same"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, modulus: int = MODULUS,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every document; of equal texts the largest id is kept."""
    prepare(docs.sparkSession)
    docs = bodies(docs, id_col, text_col)
    open_ = store(fingerprints(docs, segment, modulus), "dedup-fingerprints")
    repeated = store(open_.filter("copies > 1").select("doc_id", "text_sha256", "copies"), "dedup-repeated")
    open_ = open_.drop("copies")
    settled = None
    while True:
        groups = store(
            open_.groupBy("fp", "n_bytes").agg(F.max(F.struct("doc_id", "text_sha256")).alias("rep"), F.count("*").alias("n")), "dedup-groups"
        )
        group = groups.select("fp", "n_bytes", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_sha256").alias("rep_sha"), "n")
        rep_here = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_sha256") == F.col("rep_sha"))
        alone = group.select(F.col("rep_id").alias("doc_id"), F.col("rep_sha").alias("text_sha256"), "rep_id", "rep_sha")
        members = open_.join(group.filter("n > 1"), ["fp", "n_bytes"]).withColumn("is_rep", rep_here)
        members = store(members, "dedup-members")
        compared = store(_compare(docs, members.filter("n > 1"), chunk), "dedup-compared")
        matched = compared.filter("same").join(group.filter("n > 1"), ["fp", "n_bytes"])
        result = alone.unionByName(matched.select("doc_id", "text_sha256", "rep_id", "rep_sha"))
        settled = result if settled is None else settled.unionByName(result)
        open_ = compared.filter("not same").drop("same")
        if open_.isEmpty():
            break
    settled = _with_copies(settled, repeated)
    sizes = settled.groupBy("rep_id", "rep_sha").agg(F.sum("copies").alias("group_size"))
    sizes = sizes.select(F.col("rep_id").alias("_id"), F.col("rep_sha").alias("_sha"), "group_size")
    whole = settled.join(sizes, (F.col("rep_sha") == F.col("_sha")) & F.col("rep_id").eqNullSafe(F.col("_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_sha256") == F.col("rep_sha"))
    found = whole.select("doc_id", F.col("rep_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "copies")
    if repeated.isEmpty():
        return found.drop("copies")
    # A row again for each copy, in two steps, so that no list is long.
    some = F.sequence(F.lit(1), F.ceil(F.col("copies") / COPIES_AT_ONCE))
    found = found.withColumn("_part", F.explode(some))
    rest = F.least(F.col("copies") - (F.col("_part") - 1) * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE)).cast("int")
    return found.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), rest))).drop("copies", "_part", "_copy")


def _with_copies(settled: DataFrame, repeated: DataFrame) -> DataFrame:
    """`copies` of each row: 1, unless it is among the repeated ones."""
    many = repeated.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("copies").alias("_copies"))
    same = (F.col("text_sha256") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    found = settled.join(many, same, "left").withColumn("copies", F.coalesce("_copies", F.lit(1).cast("long")))
    return found.drop("_id", "_sha", "_copies")
