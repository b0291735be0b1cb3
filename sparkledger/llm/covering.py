"""SimHash fingerprints, and all links within a radius by covering locality-sensitive hashing.

Each of the 64 bits gets a vector of radius + 1 bits. Every nonzero vector v gives a table whose mask has the bits
with odd <vector, v>. The vectors of at most `radius` differing bits do not span the space, so that some v is
orthogonal to all of them: its mask leaves those bits out, and the pair has the same key in that table. No link is lost.

Equal fingerprints are one node. Buckets never give all their pairs: first each member is linked to the bucket's least
member where that is near enough. Of the components that this gives, only buckets that still hold several are looked
at again: those of up to `SMALL_BUCKET` nodes by comparing members of different components, larger ones by their
neighbourhoods (two fingerprints within the radius both reach one in the middle), so that work and rows are linear
in the bucket's size. What connects is exact in either way.

Defined results: null and empty texts have no words and fingerprint zero, which links like any other; rows that repeat
an id keep a row each, with the smallest id of their component; a null id is never the smallest unless all are null;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparkledger.llm.common import bodies, prepare, serve, store

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
SMALL_BUCKET = 32

# bits[b] are the eight bits of the byte b, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingles(body: bytes, size: int = SHINGLE_WORDS) -> list[bytes]:
    words = body.lower().split()  # of bytes: splits at 0x20 and 0x09-0x0D, lower-cases A-Z
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def simhash(body: bytes, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """A bit is set if it is set in over half of the shingles' hashes."""
    found = shingles(body, size)
    if not found:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in found), np.dtype(">u8"), len(found))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * counts > len(found)).tobytes(), "big")


def fingerprint_column(body: Column, size: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.arrow_udf(T.LongType())
    def prints(bodies_: pa.Array) -> pa.Array:
        serve("covering")
        return pa.array(np.array([simhash(b.as_py(), size, seed) for b in bodies_], np.uint64).view(np.int64))

    return prints(body)


def masks(radius: int = RADIUS) -> list[int]:
    """The masks of the covering tables, as signed 64-bit integers. The vectors go round all nonzero ones."""
    top = 1 << (radius + 1)
    vectors = [1 + i % (top - 1) for i in range(64)]
    found = (sum((bin(vectors[i] & v).count("1") & 1) << i for i in range(64)) for v in range(1, top))
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def components(spark: SparkSession, links: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) of all nodes that links (a, b) touch; comp is the smallest node of the component.

    Alternates two steps: each node's larger neighbours, and then its smaller ones, are linked to its least neighbour.
    Stored after each round; ends when the links are stars.
    """
    edges = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), f"{name}-links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        new = store(small.filter("a > b").distinct(), f"{name}-round")
        if new.select("b").distinct().join(new.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() and _single(new):
            break
        edges = new
    return new.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        new.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )


def _single(edges: DataFrame) -> bool:
    return edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """`rows` with the component of each fp; a node without links is its own."""
    found = rows.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
    return found.withColumn("comp", F.coalesce("comp", "fp"))


def link(prints: DataFrame, radius: int = RADIUS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(fp, comp) of distinct fingerprints that have a link; comp is the least fingerprint that they reach."""
    spark = prints.sparkSession
    given = F.array(*map(F.lit, masks(radius)))
    keyed = prints.select("fp", F.posexplode(given).alias("table", "mask")).select("table", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    sizes = keyed.groupBy("table", "key").agg(F.count("*").alias("n"), F.min("fp").alias("low")).filter("n > 1")
    buckets = store(keyed.join(sizes, ["table", "key"]), "covering-buckets")
    stars = buckets.filter((F.col("fp") != F.col("low")) & _near(F.col("fp"), F.col("low"), radius))
    comps = store(components(spark, stars.select(F.col("fp").alias("a"), F.col("low").alias("b")), "covering"), "covering-components")
    # Buckets whose members are in one component have nothing to add.
    placed = store(_with_components(buckets, comps), "covering-placed")
    mixed = placed.groupBy("table", "key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).filter("first < last").select("table", "key")
    open_ = store(placed.join(mixed, ["table", "key"]), "covering-open")
    small = open_.filter(F.col("n") <= small_bucket)
    left, right = (small.select("table", "key", F.col("fp").alias(f"fp{i}"), F.col("comp").alias(f"comp{i}")) for i in (1, 2))
    pairs = left.join(right, ["table", "key"]).filter((F.col("comp1") < F.col("comp2")) & _near(F.col("fp1"), F.col("fp2"), radius))
    more = pairs.select(F.col("comp1").alias("a"), F.col("comp2").alias("b"))
    met = _meeting(open_.filter(F.col("n") > small_bucket), radius)
    bridges = components(spark, more.unionByName(met), "covering-bridges")
    both = comps.join(bridges.select(F.col("node").alias("comp"), F.col("comp").alias("final")), "comp", "left")
    alone = bridges.join(comps.select("node"), "node", "left_anti").select(F.col("node").alias("fp"), F.col("comp").alias("comp"))
    return both.select(F.col("node").alias("fp"), F.coalesce("final", "comp").alias("comp")).unionByName(alone)


def _meeting(members: DataFrame, radius: int) -> DataFrame:
    """Links between components of a large bucket, by fingerprints in the middle.

    Two members within the radius differ only in bits outside the table's mask, and reach a common fingerprint by
    flipping at most half of them each (the first one rounded up). Whatever meets in one is within the radius, as both
    halves together flip no more bits.
    """
    near, far = radius // 2, radius - radius // 2
    parts = []
    outside = {table: [i for i in range(64) if not (mask >> i) & 1] for table, mask in enumerate(masks(radius))}
    for flips in range(far + 1):
        rows = [(t, [sum(1 << b for b in c) - ((1 << 64) if 63 in c else 0) for c in combinations(bits, flips)]) for t, bits in outside.items()]
        flipped = members.sparkSession.createDataFrame(rows, "table int, flips array<bigint>")
        spread = members.join(flipped, "table").select(
            "table", "key", "comp", F.explode("flips").alias("flip"), "fp", F.lit(flips).alias("n_flips")
        ).withColumn("middle", F.col("fp").bitwiseXOR(F.col("flip")))
        parts.append(spread.select("table", "key", "middle", "comp", "n_flips"))
    spread = parts[0]
    for part in parts[1:]:
        spread = spread.unionByName(part)
    # Whoever comes with few flips is near all others there; the least such component is linked to each of them.
    met = spread.groupBy("table", "key", "middle").agg(
        F.min(F.when(F.col("n_flips") <= near, F.col("comp"))).alias("low"), F.min("comp").alias("first"), F.max("comp").alias("last")
    ).filter(F.col("low").isNotNull() & (F.col("first") < F.col("last"))).select("table", "key", "middle", "low")
    joined = spread.join(met, ["table", "key", "middle"]).filter("comp <> low")
    return joined.select(F.col("low").alias("a"), F.col("comp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, seed: int = SEED, small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest id that links reach) for every document."""
    spark = prepare(docs.sparkSession)
    prints = bodies(docs, id_col, text_col).select("doc_id", fingerprint_column(F.col("body"), shingle_words, seed).alias("fp"))
    prints = store(prints, "simhash")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "simhash-nodes")
    placed = _with_components(nodes, link(nodes.select("fp"), radius, small_bucket))
    lowest = placed.groupBy("comp").agg(F.min("low_id").alias("component_id"))
    named = store(placed.join(lowest, "comp").select("fp", "component_id"), "simhash-components")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
