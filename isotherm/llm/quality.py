"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

Each labelled pair of a good and a poor document is a preference. A document's
strength is linear in features of its text, and the chance that i is preferred
to j is sigmoid(strength_i - strength_j); the weights minimise the logistic loss
on feature differences. The threshold is a quantile of the training scores: the
one that parts the labelled rows with the fewest errors.

The model is learned from at most ``sample_rows`` labelled rows (those with the
smallest hashes) and ``pairs`` pairs drawn from them; everything else covers
all rows. Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts have zero features and are scored like
any other; rows without a label, or with a null label, are not learned from; of
repeated labels of an id, the largest counts; equal texts get equal scores;
with no pairs (no rows, or one class) the score is the smoothed rate of label
1; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import byte_texts
from isotherm.llm.toxicity import SAMPLE_ROWS, labelled_sample

PAIRS = 200_000  # preference pairs that a model is learned from, at most
CUT = 0.3  # the score that the quantile threshold maps to
BINS = 6  # quantile bins of each feature

FEATURES = (
    "log_words", "word_length", "upper", "letters", "digits", "symbols", "exclamation", "bars", "stops", "space",
    "distinct", "top_word", "repeated_next", "repeated_pairs", "line_length", "repeated_lines", "longest_word",
    "symbol_ends",
)

_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(b for b in range(33, 127) if chr(b) in "#$%&*@^~<>=+\\{}[]_/")
_ODD_ENDS = _SYMBOLS + b"!|"
_SPACE = b" \t\n\v\f\r"


def text_features(text: bytes) -> list[float]:
    """FEATURES of one text; all zero for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    share = lambda drop: 1.0 - len(text.translate(None, drop)) / chars
    counts = Counter(words)
    pairs = list(zip(words, words[1:]))
    lines = [x for x in text.split(b"\n") if x]
    plain = text.translate(None, _SPACE)
    odd_ends = sum(1 for w in counts if w[-1] in _ODD_ENDS)
    return [
        math.log(n + 1.0),
        len(plain) / n,
        share(_UPPER),
        share(_LETTERS),
        share(_DIGITS),
        share(_SYMBOLS),
        text.count(b"!") / n,
        text.count(b"|") / n,
        text.count(b".") / n,
        share(_SPACE),
        len(counts) / n ** 0.85,
        max(counts.values()) / n,
        sum(a == b for a, b in pairs) / n,
        1.0 - len(set(pairs)) / n if pairs else 0.0,
        math.log(n / len(lines) + 1.0),
        1.0 - len(set(lines)) / len(lines),
        math.log(max(map(len, counts))),
        odd_ends / len(counts),
    ]


@dataclass
class QualityModel:
    """Bin edges and centres of the features, weights, and the scores' shift."""

    edges: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Standardised features, and for each feature which quantile bins lie below it."""
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        above = (x[:, :, None] > self.edges[None]).reshape(len(x), -1)
        return np.hstack([z, above])

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; CUT at the quantile threshold."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.strength(x) - self.shift + math.log(CUT / (1 - CUT)), -40, 40)))


def fit_pairs(expanded: np.ndarray, good: np.ndarray, poor: np.ndarray, pairs: int, seed: int = 7,
              l2: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Bradley-Terry weights: gradient descent (Adam) on the logistic loss of feature differences."""
    rng = np.random.default_rng(seed)
    total = min(pairs, 40 * max(len(good), len(poor)))
    left, right = rng.choice(good, total), rng.choice(poor, total)
    w = np.zeros(expanded.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    batch = 8192
    for k in range(1, steps + 1):
        at = rng.integers(0, total, min(batch, total))
        difference = expanded[left[at]] - expanded[right[at]]
        p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
        g = -(difference * p[:, None]).mean(0) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return w


def quantile_threshold(strength: np.ndarray, label: np.ndarray) -> float:
    """The training-score quantile (of 1000) with the fewest errors; of equal ones the lowest, which keeps most."""
    cuts = np.quantile(strength, np.linspace(0, 1, 1001))
    order = np.argsort(strength, kind="stable")
    s, y = strength[order], label[order]
    ones_below = np.concatenate([[0], np.cumsum(y == 1)])
    zeros_below = np.concatenate([[0], np.cumsum(y == 0)])
    at = np.searchsorted(s, cuts, side="left")
    errors = ones_below[at] + (zeros_below[-1] - zeros_below[at])
    best = int(np.argmin(errors))
    below = at[best] - 1
    return float(cuts[best] if below < 0 else (s[below] + cuts[best]) / 2)


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
                  pairs: int = PAIRS, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Weights and threshold from the labelled rows of ``docs`` (bounded by ``sample_rows`` and ``pairs``)."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.array(text_features(t), dtype="<f8").tobytes() for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(x, pa.binary())], names=["label", "x"])

    sample = labelled_sample(docs, labels, label, sample_rows, id_col, text_col)
    rows = sample.mapInArrow(features, "label int, x binary").orderBy("x", "label").collect()
    y = np.array([r["label"] for r in rows], dtype=int)
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    k = len(FEATURES)
    if not len(good) or not len(poor):
        rate = (len(good) + 0.5) / (len(y) + 1.0)
        return QualityModel(np.zeros((k, BINS)), np.zeros(k), np.ones(k), np.zeros(k + k * BINS),
                            math.log(CUT / (1 - CUT)) - math.log(rate / (1 - rate)))
    x = np.frombuffer(b"".join(r["x"] for r in rows), dtype="<f8").reshape(len(rows), k)
    # Bins by the quantiles of either class, as the poor rows are few.
    inner = np.linspace(0, 1, BINS // 2 + 2)[1:-1]
    edges = np.vstack([np.quantile(x[good], inner, axis=0), np.quantile(x[poor], inner, axis=0)]).T.copy()
    model = QualityModel(edges, x.mean(0), x.std(0) + 1e-9, np.zeros(0), 0.0)
    expanded = model.expand(x)
    model.weights = fit_pairs(expanded, good, poor, pairs)
    model.shift = quantile_threshold(expanded @ model.weights, y)
    return model


def quality_score(model: QualityModel, text_col: str = "text") -> F.Column:
    """The score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        x = np.array([text_features(t) for t in byte_texts(texts)], dtype=float).reshape(-1, len(FEATURES))
        return pa.array(model.score(x), pa.float64())

    return score(F.col(text_col))


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float = CUT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns."""
    return docs.filter(quality_score(model, text_col) >= threshold)
