"""Quality by compression: zstandard dictionaries of good and of bad text, and which of them makes a text smaller.

Two dictionaries are trained on a bounded sample of labelled texts. A text is cut into pieces of `PIECE_BYTES`, each
compressed with either dictionary and with none. The normalised difference of the sizes over the whole text, its
lowest value in a piece, and the sizes per byte go into a logistic regression fitted on other labelled rows; its
result is the score. Labels, language, source and id never go into a score.

Bounds of the sample: `SAMPLE_DOCS` texts of each label, chosen by the hash of the id. By the hash of the text, one half
serves the dictionaries, with at most `SAMPLE_PIECES` evenly spread pieces of each, and the other half the regression.

Defined results: null text is scored as empty; without labelled rows of both kinds every score is the share of good
ones, 0.5 without any; repeated rows and null ids are scored row by row; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkledger.llm.common import documents, prepare, serve
from sparkledger.llm.learning import Linear, fit_newton, fold, sample_labelled

PIECE_BYTES = 512
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
SAMPLE_DOCS = 4000
SAMPLE_PIECES = 32
THRESHOLD = 0.3


def pieces_of(body: bytes, size: int = PIECE_BYTES) -> list[bytes]:
    return [body[i : i + size] for i in range(0, max(len(body), 1), size)]


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Trained by zstandard; from too few samples, the samples themselves serve as the dictionary."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Sizer:
    """Compressed sizes with the two dictionaries and without one."""

    def __init__(self, good: bytes, bad: bytes):
        self.coders = [self._coder(d) for d in (good, bad, b"")]

    @staticmethod
    def _coder(content: bytes) -> zstandard.ZstdCompressor:
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(content) < 8:
            return zstandard.ZstdCompressor(**plain)
        held = zstandard.ZstdCompressionDict(content)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=held, **plain)

    def inputs(self, body: bytes) -> tuple[float, float, float, float]:
        """The normalised difference, its least value in a piece, and bytes out per byte in with `good` and without."""
        good = bad = bare = 0
        least = 1.0
        for piece in pieces_of(body):
            g, b, n = (len(coder.compress(piece)) for coder in self.coders)
            good, bad, bare = good + g, bad + b, bare + n
            least = min(least, (b - g) / max(b, g))
        size = max(len(body), 1)
        return (bad - good) / max(bad, good), least, good / size, bare / size


@dataclasses.dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    linear: Linear

    def column(self, text: Column) -> Column:
        """The score of a text: 0 to 1, higher where label 1 is likelier."""
        good, bad, linear = self.good, self.bad, self.linear

        @F.arrow_udf(T.DoubleType())
        def score(bodies: pa.Array) -> pa.Array:
            serve("quality")
            sizer = Sizer(good, bad)
            return pa.array(linear(np.array([sizer.inputs(b) for b in bodies.to_pylist()])) if len(bodies) else [], pa.float64())

        return score(F.coalesce(text.cast("binary"), F.lit(b"")))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
    sample_docs: int = SAMPLE_DOCS, sample_pieces: int = SAMPLE_PIECES,
) -> QualityModel:
    """Learn dictionaries and calibration from the labelled rows whose fold is not 0."""
    prepare(docs.sparkSession)
    rows, shares = sample_labelled(documents(docs, id_col, text_col), labels, label, sample_docs)
    # Texts for the dictionaries and for the calibration differ, as sizes of texts in a dictionary are too small.
    half = F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(2))

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def spread(bodies: pa.Array) -> pa.Array:
        serve("quality")

        def chosen(body):
            pieces = pieces_of(body)
            return [pieces[i] for i in np.unique(np.linspace(0, len(pieces) - 1, sample_pieces).astype(int))]

        return pa.array([chosen(b) for b in bodies.to_pylist()], pa.list_(pa.binary()))

    taken = rows.filter(half == 0).select("y", spread(F.col("text").cast("binary")).alias("pieces")).collect()
    good, bad = (dictionary([bytes(p) for row in taken if row["y"] == y for p in row["pieces"]]) for y in (1, 0))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def inputs(bodies: pa.Array) -> pa.Array:
        serve("quality")
        sizer = Sizer(good, bad)
        return pa.array([sizer.inputs(b) for b in bodies.to_pylist()], pa.list_(pa.float64()))

    held = rows.filter(half == 1).select("y", inputs(F.col("text").cast("binary")).alias("x")).collect()
    x, y = np.array([r["x"] for r in held]).reshape(-1, 4), np.array([r["y"] for r in held], float)
    # Each row stands for as many rows of its label as the table has.
    weight = np.array([shares[int(v)] / int((y == v).sum()) for v in y])
    if len(y) == 0 or y.min() == y.max():
        total = sum(shares.values())
        x, y, weight = np.zeros((0, 4)), np.array([]), None
        share = shares.get(1, 0) / total if total else 0.5
        return QualityModel(good, bad, dataclasses.replace(fit_newton(x, y), bias=float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))))
    return QualityModel(good, bad, fit_newton(x, y, weight * len(y) / weight.sum(), ridge=1e-5))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    prepare(docs.sparkSession)
    scored = documents(docs, id_col, text_col).select("doc_id", (fold() == 0).alias("held_out"), model.column(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
