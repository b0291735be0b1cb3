"""Benchmark items in documents: a set join that looks up only the rarest word of each window.

An item gives windows of `window` consecutive words; one with fewer words is a window of its own. A document contains
a window only if it has all its words, so that the prefix of length one of the window's words, ordered by how rare
they are in the corpus, is a necessary token. Documents' words join those tokens; the token's place in the window
gives the place of the window, which has to lie within the document, and there all words are compared. Only DataFrame
functions are used; the corpus is never compared with more than the windows of one word. Windows that measure small are
broadcast, and compared where the text is read; others meet the documents in shuffled joins, with the same results.

Defined results: null and empty texts have no words, nothing hit and no items; items without words have no windows;
items that repeat an id or a text count once by id; null item ids are listed as nothing; rows that repeat id and text
keep a row each; empty tables give no rows, or rows without hits where only the benchmark is empty; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkledger.llm.common import documents, prepare, store

WINDOW = 10
# Windows of up to so many bytes, as measured, are broadcast; others are met by shuffles.
BROADCAST_BYTES = 32 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What separates words, A-Z being lower-cased before: all of ASCII but digits and letters.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def words(text: Column) -> Column:
    """The words of a text in order."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, UPPER.lower() + " " * len(SEPARATORS))
    return F.array_remove(F.split(plain, " "), "")


def item_windows(benchmark: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows with the items that have them: window (array of words), items (array of ids as text)."""
    items = documents(benchmark, id_col, text_col).select(F.col("doc_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    n = F.size("w")
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))))
    each = items.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), size).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items"))


def rarest_words(windows: DataFrame, docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The windows with `token`, their word that is rarest in all documents, and `offset`, its first place."""
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    found, n = docs.select(F.explode("w").alias("word")), F.count("*").alias("n")
    if _size(windows) <= broadcast_bytes:
        counts = found.join(F.broadcast(vocabulary), "word").groupBy("word").agg(n)
    else:  # tasks count before words move, so that a frequent word is a row of each
        counts = found.groupBy("word").agg(n).join(vocabulary, "word")
    each = windows.select("window", F.posexplode("window").alias("offset", "word")).join(counts, "word", "left")
    rarest = each.groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("r"))
    # A window with a word that no document has cannot occur.
    found = rarest.filter("r.n > 0").select("window", F.col("r.word").alias("token"), F.col("r.offset").alias("offset"))
    return found.join(windows, "window")


def contained(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """doc_id, n_words, hit (sorted places of hit words, from 0) and items (sorted ids as text) of every document."""
    prepare(docs.sparkSession)
    texts = documents(docs, id_col, text_col)
    split = texts.select("doc_id", words(F.col("text")).alias("w"))
    tokens = store(rarest_words(store(item_windows(benchmark, window), "leak-windows"), split, broadcast_bytes), "leak-tokens")
    # A document is its id and text; as a struct, a null id equals a null id.
    rows = texts.select(F.struct("doc_id", F.xxhash64("text").alias("digest")).alias("row"), words(F.col("text")).alias("w"), "text")
    look_up = _by_broadcast if _size(tokens) <= broadcast_bytes else _by_shuffle
    every, found = look_up(rows, tokens)
    span = F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("size") - 1))))
    # Rows that repeat id and text have the same hits.
    hits = found.groupBy("row").agg(F.array_sort(span).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    none = F.array().cast("array<int>"), F.array().cast("array<string>")
    return every.join(hits, "row", "left").select(
        "row.doc_id", F.col("n").cast("long").alias("n_words"), F.coalesce("hit", none[0]).alias("hit"), F.coalesce("items", none[1]).alias("items")
    )


def _size(windows: DataFrame) -> int:
    """Bytes of the windows with their items and a token, with a margin for each value's place."""
    size = lambda c: F.octet_length(F.concat_ws(" ", c)) + 16 * F.size(c)
    return windows.select(F.sum(2 * size("window") + size("items") + 64)).first()[0] or 0


def _by_broadcast(rows: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (row, n) and the windows in them (row, start, size, items), from one scan that moves no text.

    An empty word, which no text has, ends each document and meets an empty window: that is the document's own row.
    """
    ending = rows.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("window"), F.lit("").alias("token"), F.lit(0).alias("offset"), F.array().cast("array<string>").alias("items")
    )
    windows = tokens.select("window", "token", "offset", "items").unionByName(ending)
    places = rows.select("row", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("at", "token"))
    start, size = F.col("at") - F.col("offset"), F.size("window")
    inside = (start >= 0) & (start + size <= F.size("w"))
    # The first words are compared before the whole windows.
    same = (F.get("w", start) == F.get("window", F.lit(0))) & (F.slice("w", start + 1, size) == F.col("window"))
    met = places.join(F.broadcast(windows), "token").filter((F.col("token") == "") | (inside & same))
    met = store(met.select("row", F.size("w").alias("n"), start.alias("start"), size.alias("size"), "items"), "leak-met")
    return met.filter("size = 0").select("row", "n"), met.filter("size > 0").select("row", "start", "size", "items")


def _by_shuffle(rows: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for windows of any size: places meet the tokens, and the texts with candidates move once."""
    # One row for each token, so that a frequent word meets one row; its windows are a list no longer than the benchmark.
    by_token = tokens.groupBy("token").agg(F.collect_list(F.struct("offset", "window", "items")).alias("windows"))
    by_token = store(by_token, "leak-prefixes")
    lookup = by_token.select("token", F.transform("windows", lambda w: F.struct(w["offset"].alias("offset"), F.size(w["window"]).alias("size"))).alias("bounds"))
    places = rows.select("row", F.size("w").alias("n"), F.posexplode("w").alias("at", "token"))
    fits = F.exists("bounds", lambda b: (F.col("at") >= b["offset"]) & (F.col("at") - b["offset"] + b["size"] <= F.col("n")))
    met = places.join(lookup, "token").filter(fits).select("row", "token", "at")
    candidates = store(met.groupBy("row", "token").agg(F.collect_set("at").alias("places")), "leak-candidates")
    tried = candidates.join(by_token, "token").select("row", "places", F.explode("windows").alias("p"))
    tried = tried.select("row", F.explode("places").alias("at"), "p").select("row", (F.col("at") - F.col("p.offset")).alias("start"), "p.window", "p.items")
    grouped = tried.filter("start >= 0").groupBy("row").agg(F.collect_list(F.struct("start", "window", "items")).alias("tried"))
    grouped = store(grouped, "leak-tried").filter(F.size("tried") > 0).hint("shuffle_hash")
    # Exploded, so that each text is split once and not for each window tried.
    chosen = rows.select("row", "text").join(grouped, "row").select("row", words(F.col("text")).alias("w"), "tried")
    each = chosen.select("row", "w", F.explode("tried").alias("t"))
    same = F.slice("w", F.col("t.start") + 1, F.size("t.window")) == F.col("t.window")
    found = store(each.filter(same).select("row", "t.start", F.size("t.window").alias("size"), "t.items"), "leak-met")
    return rows.select("row", F.size("w").alias("n")), found


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = contained(docs, benchmark, **options)
    n_hit = F.size("hit").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
