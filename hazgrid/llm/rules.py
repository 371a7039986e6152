"""Quality rules over document statistics: two fixed rules and gradient-boosted trees.

A whole text becomes a row of counts (words, symbols, repeated lines and words) and of shares
made from them and from kinds of characters. Trees of a fixed depth are boosted on the shares of
labelled documents with the logistic loss, split on quantiles of the values, and kept
monotonic where more must never be better: a split against the direction is not taken, and
the values below a split stay on their side of its middle. Fitted trees lie flat in numpy
arrays, level by level, so a batch of documents goes down a tree in as many steps as it has levels.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample, slices, whole_text

#: The characters that count as symbols, and the two rules.
SYMBOLS, LEAST_WORDS, MOST_REPEATED = "#*$%&|<>", 50, 50
#: Labelled documents per label to fit on at most; trees, their depth, step, penalty, and cuts of a feature.
SAMPLE, TREES, DEPTH, RATE, PENALTY, CUTS = 4_000, 60, 3, 0.2, 1.0, 48

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbols", "dup_lines", "repeat_words", "distinct_words", "doubled_words",
    "capitals", "digits", "marks", "exclaimed", "ends", "lines", "beyond_ascii",
)
#: Features of which more never raises the score.
FALLING = ("symbols", "dup_lines", "repeat_words", "doubled_words", "capitals", "exclaimed")
_BLANKS = " \t\n\x0b\x0c\r"
_CAPITALS, _DIGITS, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\"'(),-./:;?@[]_{}~"


def counted(text: str) -> tuple[list[int], list[float]]:
    """The ``COUNTS`` and ``FEATURES`` of a whole text; all but the shares of an empty one are zero too."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    again = len(lines) - len(set(lines))
    repeated = _in_repeats(words)
    per_word, per_char, size = 1 / max(1, n), 1 / max(1, chars), len(data)
    kinds = [size - len(data.translate(None, kind)) for kind in (_CAPITALS, _DIGITS, _MARKS)]
    shares = [
        math.log1p(n), chars * per_word, symbols * per_char, again / max(1, len(lines)), repeated * per_word,
        len(set(words)) * per_word, sum(map(eq, words, words[1:])) * per_word,
        *(k * per_char for k in kinds), data.count(b"!") * per_char, data.count(b".") * per_word,
        len(lines) * per_word, (size - len(text)) * per_char,
    ]
    return [n, chars, symbols, again, repeated], shares


def _in_repeats(words: list[bytes]) -> int:
    """Words that stand in a window of three words found more than once."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    inside = bytearray(len(words))
    for at, window in enumerate(windows):
        if found[window] > 1:
            inside[at : at + 3] = b"\1\1\1"
    return sum(inside)


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees, level by level: node i has the children 2i + 1 (not above the cut) and 2i + 2."""

    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray      # (trees, inner nodes), infinite where a node is not split
    value: np.ndarray    # (trees, leaves)
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Chance that each row (of ``FEATURES``) is of good quality."""
        total, at_row = np.full(len(rows), self.base), np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(rows), "i4")
            while len(node) and node[0] < len(feature):  # all rows are on one level
                node = 2 * node + 1 + (rows[at_row, feature[node]] > cut[node])
            total += value[node - len(feature)] if len(node) else 0
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_trees(rows: np.ndarray, good: np.ndarray, directions: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost on ``rows`` (documents by features) and labels 0 and 1; both labels weigh the same in all.

    ``directions``: 1 where more must not lower the score, -1 where it must not raise it, 0 where either may be.
    With fewer than two labels nothing is known and every score is a half.
    """
    inner = 2**depth - 1
    have = np.bincount(good, minlength=2)
    if (have == 0).any():
        return Trees(np.zeros((0, inner), "i4"), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    weight = (len(good) / (2 * have))[good]
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2)[1:-1])) for column in rows.T]
    bins = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T)], axis=1)
    margin = np.zeros(len(rows))
    grown = []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, curve = weight * (good - chance), weight * chance * (1 - chance)
        feature, cut, value = np.zeros(inner, "i4"), np.full(inner, np.inf), np.zeros(inner + 1)
        level = [(0, np.arange(len(rows)), -np.inf, np.inf)]
        while level:
            node, members, low, high = level.pop()
            here = float(np.clip(slope[members].sum() / (curve[members].sum() + PENALTY), low, high))
            if node >= inner:
                value[node - inner] = RATE * here
                margin[members] += RATE * here
                continue
            split = _best_split(bins, cuts, members, slope, curve, directions, low, high)
            below_low, below_high, above_low, above_high = low, high, low, high
            if split is None:  # everything goes on to the left; what no row reaches has the same value
                lower, upper = members, members[:0]
                above_low = above_high = below_low = below_high = here
            else:
                f, b, middle = split
                feature[node], cut[node] = f, cuts[f][b]
                right = bins[members, f] > b
                lower, upper = members[~right], members[right]
                if directions[f] > 0:
                    below_high, above_low = min(high, middle), max(low, middle)
                elif directions[f] < 0:
                    below_low, above_high = max(low, middle), min(high, middle)
            level.append((2 * node + 1, lower, below_low, below_high))
            level.append((2 * node + 2, upper, above_low, above_high))
        grown.append((feature, cut, value))
    return Trees(*(np.stack(part) for part in zip(*grown)), 0.0)


def _best_split(bins, cuts, members, slope, curve, directions, low, high):
    """(feature, bin, middle value) of the split that gains most, None where none gains."""
    best, gain_of = None, 1e-9
    g, h = slope[members], curve[members]
    whole = g.sum() ** 2 / (h.sum() + PENALTY)
    for f, own in enumerate(cuts):
        of = bins[members, f]
        left_g = np.cumsum(np.bincount(of, g, len(own) + 1))[:-1]
        left_h = np.cumsum(np.bincount(of, h, len(own) + 1))[:-1]
        n = np.cumsum(np.bincount(of, minlength=len(own) + 1))[:-1]
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - whole
        left, right = (np.clip(a / (b + PENALTY), low, high) for a, b in ((left_g, left_h), (right_g, right_h)))
        allowed = (n > 0) & (n < len(members)) & (directions[f] * (right - left) >= 0)
        if allowed.any():
            b = int(np.argmax(np.where(allowed, gain, -np.inf)))
            if gain[b] > gain_of:
                best, gain_of = (f, b, float(left[b] + right[b]) / 2), float(gain[b])
    return best


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Fit on about ``sample`` documents of each quality label at most; labels of fold 0 are not looked at.

    Only statistics of the sampled documents are gathered, a few numbers for each, in one task.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).filter(in_fold() != 0)
    chosen = labelled_sample(texts, labels.filter(in_fold() != 0), "quality", sample).filter("grade IN (0, 1)")
    chosen = chosen.select("doc_id", "text", F.col("grade").cast("int").alias("grade"), F.lit("all").alias("one"))

    def features(frames):
        for frame in frames:
            rows = [counted(text)[1] for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "grade": frame["grade"], "row": rows, "one": frame["one"]})

    directions = np.array([-1 if f in FALLING else 0 for f in FEATURES])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id")
        model = fit_trees(np.stack(frame["row"].to_numpy()), frame["grade"].to_numpy("i8"), directions, trees, depth)
        parts = zip(model.feature.tolist(), model.cut.tolist(), model.value.tolist())
        return pd.DataFrame([(i, *part) for i, part in enumerate(parts)], columns=["tree", "feature", "cut", "value"])

    schema = "tree int, feature array<int>, cut array<double>, value array<double>"
    rows = chosen.mapInPandas(features, "doc_id long, grade int, row array<double>, one string")
    found = sorted(rows.groupBy("one").applyInPandas(run, schema).collect())  # one row for each tree
    if not found:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0, "i8"), directions, trees, depth)
    return Trees(*(np.array([row[part] for row in found]) for part in ("feature", "cut", "value")), 0.0)


def judged(docs: DataFrame, model: Trees, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with its counts, ``score``, ``base_failed`` and ``kept``.

    Missing and empty texts have no words, and so fail. Repeated rows each get a row; an empty
    table gives an empty result. Columns of ``keep`` that have the name of a result are replaced.
    """
    results = {**dict.fromkeys(COUNTS, "bigint"), "score": "double"}
    keep = tuple(c for c in keep if c.lower() not in {*results, "base_failed", "kept"})
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], whole_text().alias("text"))
    own = [f"k{i}" for i in range(len(keep))]
    schema = rows.select(*own, *[F.lit(0).cast(kind).alias(name) for name, kind in results.items()]).schema

    def run(batches):
        for batch in slices(batches):
            found = [counted(text) for text in batch.column("text").to_pylist()]
            scores = model.score(np.array([shares for _, shares in found], "f8").reshape(len(found), len(FEATURES)))
            numbers = np.array([counts for counts, _ in found], "i8").reshape(len(found), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), *map(pa.array, np.ascontiguousarray(numbers.T)), pa.array(scores)],
                names=[*own, *results],
            )

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.mapInArrow(run, schema).select(
        *[F.col(k).alias(c) for k, c in zip(own, keep)], *results,
        failed.alias("base_failed"), (~failed & (F.col("score") >= 0.5)).alias("kept"),
    )
