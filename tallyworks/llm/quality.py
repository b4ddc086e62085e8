"""Document quality by a generalised additive model with pairwise interactions.

Each feature has a table of values by bin, some pairs of features have a table by
both bins, and a score is the sum of what the tables hold. The tables are learnt by
boosting that goes round the features: each turn fits one shallow tree to what is
left to explain and adds it to that feature's table.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import documents, written

TRAIN_ROWS = 100_000   # labelled rows that are gathered to learn from, at most
BINS = 32
PAIR_BINS = 8
PAIRS = 6              # interactions, the strongest ones
ROUNDS = 120
RATE = 0.15
LEAVES = 4             # of a tree over the bins of one feature
THRESHOLD = 0.3

FEATURES = [
    "log_chars", "word_length", "upper", "digits", "marks", "bars", "beyond_ascii", "distinct_words", "top_word",
    "words_in_line", "repeated_lines", "odd_words", "spaces", "byte_entropy",
]


def features_of(text: str | None) -> list[float]:
    """Shape and repetition of a text: nothing that names its language, source or id."""
    data = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    count = np.bincount(data, minlength=256).astype(float)
    size, n = float(len(data)), float(len(words))
    lines = [line for line in text.split("\n") if line]
    upper, digits = count[65:91].sum(), count[48:58].sum()
    letters = upper + count[97:123].sum()
    marks = count[33:127].sum() - letters - digits
    often = Counter(words)
    share = count[count > 0] / size
    odd = sum(k for word, k in often.items() if not (word[-1].isalnum() or word[-1] in ".,"))
    return [
        math.log(size), size / n, upper / size, digits / size, marks / size, count[124] / size,
        count[128:].sum() / size, len(often) / n, max(often.values()) / n, n / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1), odd / n, count[[9, 10, 32]].sum() / size,
        float(-(share * np.log(share)).sum()),
    ]


class AdditiveModel:
    """Tables by bin for single features and for pairs of them."""

    def __init__(self, start: float, edges: list[np.ndarray], tables: list[np.ndarray],
                 pairs: list[tuple[int, int]], pair_tables: list[np.ndarray]):
        self.start, self.edges, self.tables, self.pairs, self.pair_tables = start, edges, tables, pairs, pair_tables

    @staticmethod
    def _bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, values[:, j], side="right") for j, e in enumerate(edges)], axis=1)

    @staticmethod
    def _coarse(bins: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(e) + 1 for e in edges])
        return bins * PAIR_BINS // np.maximum(sizes, 1)

    def margin(self, values: np.ndarray) -> np.ndarray:
        bins = self._bins(values, self.edges)
        coarse = self._coarse(bins, self.edges)
        total = np.full(len(values), self.start)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[:, a] * PAIR_BINS + coarse[:, b]]
        return total

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(values), -30, 30)))

    @staticmethod
    def _tree(slope: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
        """Step values over ordered bins: split where it helps most, until there are enough leaves."""
        cuts = [0, len(slope)]
        gain_of = lambda g, h: g * g / (h + 1.0)
        while len(cuts) <= leaves:
            best = None
            for lo, hi in zip(cuts, cuts[1:]):
                if hi - lo < 2:
                    continue
                g, h = np.cumsum(slope[lo:hi]), np.cumsum(weight[lo:hi])
                gain = gain_of(g[:-1], h[:-1]) + gain_of(g[-1] - g[:-1], h[-1] - h[:-1]) - gain_of(g[-1], h[-1])
                at = int(np.argmax(gain))
                if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
                    best = (gain[at], lo + at + 1)
            if best is None:
                break
            cuts = sorted([*cuts, best[1]])
        out = np.zeros(len(slope))
        for lo, hi in zip(cuts, cuts[1:]):
            out[lo:hi] = slope[lo:hi].sum() / (weight[lo:hi].sum() + 1.0)
        return out

    @classmethod
    def fit(cls, values: np.ndarray, labels: np.ndarray) -> AdditiveModel:
        """``labels`` are 0 or 1. Without rows of both kinds the score is a constant."""
        k = len(FEATURES)
        if not len(labels):
            return cls(0.0, [np.zeros(0)] * k, [np.zeros(1)] * k, [], [])
        start = math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
        edges = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
        model = cls(start, edges, [np.zeros(len(e) + 1) for e in edges], [], [])
        bins = cls._bins(values, edges)
        coarse = cls._coarse(bins, edges)
        margin = np.full(len(labels), start)

        def slopes():
            p = 1 / (1 + np.exp(-margin))
            return labels - p, p * (1 - p)

        for _ in range(ROUNDS):
            for j in range(k):
                g, h = slopes()
                n = len(model.tables[j])
                step = RATE * cls._tree(
                    np.bincount(bins[:, j], g, minlength=n), np.bincount(bins[:, j], h, minlength=n), LEAVES
                )
                model.tables[j] += step
                margin += step[bins[:, j]]
        g, h = slopes()
        strength = []
        for a, b in combinations(range(k), 2):
            cell = coarse[:, a] * PAIR_BINS + coarse[:, b]
            sums = np.bincount(cell, g, minlength=PAIR_BINS**2)
            strength.append(((sums**2 / (np.bincount(cell, h, minlength=PAIR_BINS**2) + 1.0)).sum(), (a, b)))
        model.pairs = [pair for _, pair in sorted(strength, reverse=True)[:PAIRS]]
        model.pair_tables = [np.zeros(PAIR_BINS**2) for _ in model.pairs]
        cells = [coarse[:, a] * PAIR_BINS + coarse[:, b] for a, b in model.pairs]
        for _ in range(ROUNDS // 4):
            for table, cell in zip(model.pair_tables, cells):
                g, h = slopes()
                step = RATE * np.bincount(cell, g, minlength=PAIR_BINS**2) / (
                    np.bincount(cell, h, minlength=PAIR_BINS**2) + 1.0
                )
                table += step
                margin += step[cell]
        return model


def featured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, features array<double>)`` of every row, in one pass over the texts."""
    kind = docs.schema[id_column].dataType.simpleString()

    def measure(batches):
        for batch in batches:
            values = [features_of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, type=pa.list_(pa.float64()))], names=[id_column, "features"]
            )

    return docs.select(id_column, text_column).mapInArrow(measure, f"`{id_column}` {kind}, features array<double>")


def held_out(id_column: str = "doc_id"):
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def fit(measured: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Learn from labelled rows that are not held out, ``rows`` of them at most, drawn by a hash of their id."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    table = (
        measured.join(known, "doc_id").select("features", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).toArrow()
    )
    values = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return AdditiveModel.fit(values, table["quality"].to_numpy().astype(float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts have all features 0 and get a score like any other.
    Rows with null ids are scored but never learnt from. Without labels, every
    score is 0.5. Repeated rows get equal scores; ``lang``, ``source`` and other
    columns are not read.
    """
    measured = written(featured(docs), "quality-features")
    model = fit(measured, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(values))], names=["doc_id", "score"]
            )

    return measured.mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return scored(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
