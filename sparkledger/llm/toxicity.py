"""Toxicity by a classifier chain over categories.

The labels say whether a text is toxic, not how. A labelled toxic text belongs to a category if it has one of the
category's terms; the last link of the chain is the label itself. Each link is a linear model over which words of a
learned vocabulary a text has, and over the probabilities of all earlier links. It is trained on out-of-fold
probabilities, those of models that have not seen the row, so that later links see what they will see on new texts.

The vocabulary is the words, and beginnings of words, whose document counts in the sample tell toxic texts from others
best. Bounds, all parameters: `WORDS` words, and a sample of `SAMPLE_DOCS` rows of each label, chosen by the hash of the id.

Defined results: null and empty texts have no words and get the score of such texts; without labelled rows of both
kinds every score is the share of toxic ones, 0 without any; categories without enough examples are left out of the
chain and have probability 0; repeated rows and null ids are scored row by row; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import dataclasses
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sparkledger.llm.common import documents, prepare
from sparkledger.llm.learning import FOLDS, Linear, constant, fit_gradient, sample_labelled

WORDS = 512
SAMPLE_DOCS = 3000
LEAST_EXAMPLES = 20

# Terms that place a labelled toxic text in a category.
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "clown", "loser", "fool", "dumb", "imbecile"),
    "contempt": ("worthless", "pathetic", "disgusting", "trash", "scum", "garbage", "vermin", "filth"),
    "threat": ("kill", "murder", "hurt", "destroy", "strangle", "punish", "shoot", "burn"),
}
NAMES = (*CATEGORIES, "toxic")

_WORD = re.compile(r"[^\W\d_]+")


PREFIXES = (4, 5, 6)


def words_of(text: str | None) -> set[str]:
    """The words of a text, and as ^... their beginnings, as inflected words share a stem."""
    if not text:
        return set()
    words = set(_WORD.findall(text.lower()))
    return words.union(*({"^" + w[:n] for w in words if len(w) >= n} for n in PREFIXES))


@dataclasses.dataclass(frozen=True)
class Chain:
    words: tuple[str, ...]
    links: tuple[Linear, ...]  # one for each of NAMES
    threshold: float = 0.5  # of the last link, the best on out-of-fold probabilities

    def predict(self, x: np.ndarray) -> np.ndarray:
        """A column of probabilities for each link; each link sees those before it."""
        out = np.zeros((len(x), 0))
        for link in self.links:
            out = np.c_[out, link(np.c_[x, out])]
        return out


def presence(texts: list, places: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(texts), len(places)), np.float32)
    for row, text in zip(x, texts):
        row[[places[w] for w in words_of(text).intersection(places)]] = 1
    return x


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the highest F1; of equally good ones, that in the widest gap of log odds."""
    order = np.argsort(-p, kind="stable")
    z = np.log(p[order]) - np.log1p(-p[order])
    hits, flagged = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    f1 = 2 * hits / (flagged + (weight * y).sum())
    gap = np.append(z[:-1] - z[1:], 0.0)
    f1 = np.where(gap > 0, f1, 0)
    at = max(np.flatnonzero(f1 >= f1.max() - 1e-9), key=lambda i: gap[i])
    return float(1 / (1 + np.exp(-(z[at] - gap[at] / 2))))


def vocabulary(rows: DataFrame, n: int) -> list[str]:
    """The n words whose document counts differ most between the labels, by the G statistic."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(words_of(t)) for t in texts.to_pylist()], pa.list_(pa.string()))

    counts = rows.select("y", F.explode(words("text")).alias("word")).groupBy("word").agg(
        F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b")
    )
    total = rows.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("a"), F.coalesce(F.sum(1 - F.col("y")), F.lit(0)).alias("b")).first()
    if not total["a"] or not total["b"]:
        return []
    share = F.lit(float(total["a"] / (total["a"] + total["b"])))
    seen = F.col("a") + F.col("b")

    def term(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    gain = term(F.col("a"), seen * share) + term(F.col("b"), seen * (1 - share))
    return [r["word"] for r in counts.select("word", gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(n).collect()]


def fit_chain(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
    n_words: int = WORDS, sample_docs: int = SAMPLE_DOCS, least_examples: int = LEAST_EXAMPLES,
) -> Chain:
    """Learn the chain from the labelled rows whose fold is not 0."""
    prepare(docs.sparkSession)
    rows, shares = sample_labelled(documents(docs, id_col, text_col), labels, label, sample_docs)
    places = {w: i for i, w in enumerate(vocabulary(rows, n_words))}
    terms = {t: i for i, group in enumerate(CATEGORIES.values()) for t in group}

    @F.arrow_udf(T.StructType([T.StructField("x", T.ArrayType(T.IntegerType())), T.StructField("categories", T.ArrayType(T.IntegerType()))]))
    def inputs(texts: pa.Array) -> pa.Array:
        out = []
        for words in map(words_of, texts.to_pylist()):
            out.append({"x": sorted(places[w] for w in words.intersection(places)), "categories": sorted({terms[w] for w in words.intersection(terms)})})
        return pa.array(out, pa.struct([("x", pa.list_(pa.int32())), ("categories", pa.list_(pa.int32()))]))

    # Copies of a text share its fold.
    folds_ = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold")
    sample = rows.select("doc_id", "y", folds_, inputs("text").alias("i")).select("doc_id", "y", "fold", "i.*").orderBy("doc_id").collect()
    n = len(places)
    y = np.array([r["y"] for r in sample], float)
    if not len(y) or y.min() == y.max():
        empty = [constant(n + i, 0.0) for i in range(len(CATEGORIES))]
        return Chain(tuple(places), (*empty, constant(n + len(CATEGORIES), float(y.mean()) if len(y) else 0.0)))
    x = np.zeros((len(sample), n), np.float32)
    for row, r in zip(x, sample):
        row[r["x"]] = 1
    folds = np.array([r["fold"] for r in sample])
    weight = np.array([shares[int(v)] / (y == v).sum() for v in y])
    targets = [y * np.array([c in r["categories"] for r in sample]) for c in range(len(CATEGORIES))] + [y]
    links, earlier = [], np.zeros((len(sample), 0))
    for target in targets:
        seen = np.c_[x, earlier]
        if target.sum() < least_examples and target is not y:
            links.append(constant(seen.shape[1], 0.0))
            earlier = np.c_[earlier, np.zeros(len(sample))]
            continue
        out_of_fold = np.zeros(len(sample))
        for k in range(FOLDS):
            model = fit_gradient(seen[folds != k], target[folds != k], weight[folds != k])
            out_of_fold[folds == k] = model(seen[folds == k])
        links.append(fit_gradient(seen, target, weight))
        earlier = np.c_[earlier, out_of_fold]
    return Chain(tuple(places), tuple(links), best_threshold(np.clip(earlier[:, -1], 1e-9, 1 - 1e-9), y, weight))


def score_toxicity(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the probability of each category, score (that of the last link), predicted and toxic (whether the score reaches the threshold) for every document."""
    prepare(docs.sparkSession)
    places = {w: i for i, w in enumerate(chain.words)}
    kind = T.StructType([T.StructField(name, T.DoubleType()) for name in NAMES])

    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        out = chain.predict(presence(texts.to_pylist(), places)) if len(texts) else np.zeros((0, len(NAMES)))
        return pa.StructArray.from_arrays([pa.array(column, pa.float64()) for column in out.T], names=list(NAMES))

    scored = documents(docs, id_col, text_col).select("doc_id", predict("text").alias("p"))
    flagged = F.col("score") >= chain.threshold
    return scored.select("doc_id", *(F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES), F.col("p.toxic").alias("score")).select(
        "*", flagged.cast("int").alias("predicted"), flagged.alias("toxic")
    )
