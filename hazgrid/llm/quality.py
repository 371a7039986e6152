"""Quality of documents by ordinal cumulative-link regression on hashed words.

Every word and its shape (letters as one ``a``, digits as one ``0``, other marks as they are)
have a place among ``PLACES`` hashed weights, and so has a word that repeats the one before.
The mean weight over a document's words is its value s. Ordered thresholds, which share these
weights, cut the line of values into grades: P(grade >= k) = 1 / (1 + exp(t_k - s)). The
expected grade is the sum of these tails; selection is by one tail.

Weights are fitted on a bounded sample of graded documents, whose features are counted where
they are read and gathered, eight bytes each, in one task; scoring reads whole texts, one row at a time.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample, whole_text, with_text_result

#: Weights, graded documents per grade to fit on at most, steps of the fit and its penalty.
PLACES, SAMPLE, STEPS, PENALTY = 1 << 15, 4_000, 150, 1e-3
#: Words whose weight a worker remembers; then it starts anew.
REMEMBERED = 200_000
#: Grades of the labels table: poor, sound but toxic, sound.
GRADE = "CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END"
#: The place of repeats and how many words one counts for: they are one weight, words are many.
REPEAT, REPEATED = 0, 4

_letters, _digits = re.compile(r"[^\W\d_]+").sub, re.compile(r"\d+").sub


def place(feature: str) -> int:
    return 1 + zlib.crc32(feature.encode("utf-8", "surrogatepass")) % (PLACES - 1)


def places(word: str) -> tuple[int, int]:
    """Of the word without its marks, and of its shape."""
    low = word.lower()
    return place("w " + low.strip(".,;:!?\"'()")), place("s " + _digits("0", _letters("a", low)))


def counts(text: str) -> dict[int, float]:
    """Hashed features of a text with their shares of its words; an empty text has none."""
    words = text.split()
    found: dict[int, float] = {}
    each = 1 / max(1, len(words))
    for word in words:
        for at in places(word):
            found[at] = found.get(at, 0.0) + each
    found[REPEAT] = REPEATED * each * sum(map(eq, words, words[1:]))
    return found


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: tuple[float, ...]  # ascending, one for each grade above the lowest


class Weigher(dict):
    """The summed weight of each word, remembered."""

    def __init__(self, model: Model):
        self.weights = model.weights

    def __missing__(self, word: str) -> float:
        a, b = places(word)
        value = self[word] = float(self.weights[a] + self.weights[b])
        return value

    def value(self, text: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        words = text.split()
        repeats = REPEATED * sum(map(eq, words, words[1:]))
        return (sum(map(self.__getitem__, words)) + repeats * self.weights[REPEAT]) / max(1, len(words))


def fit_counts(rows: list[dict[int, float]], grades: np.ndarray, steps: int = STEPS) -> Model:
    """``fit_shares`` for the ``counts`` of texts."""
    at = np.array([i for row in rows for i in row], "i4")
    share = np.array([x for row in rows for x in row.values()], "f4")
    return fit_shares(np.array([len(row) for row in rows]), at, share, grades, steps)


def fit_shares(sizes: np.ndarray, at: np.ndarray, share: np.ndarray, grades: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum penalised likelihood by Adam; grades are 0, 1, ... and every grade has the same weight.

    ``at`` and ``share`` are the features of all rows, one row after the other, ``sizes`` how many each has.
    """
    top = int(grades.max(initial=0))
    if top < 1:
        return Model(np.zeros(PLACES), (0.0,))
    rows = len(sizes)
    of = np.repeat(np.arange(rows, dtype="i4"), sizes)
    have = np.bincount(grades, minlength=top + 1)
    each = (rows / ((have > 0).sum() * np.maximum(have, 1)))[grades] / rows
    weights, steps_in = np.zeros(PLACES), np.array([0.0, *np.full(top - 1, 0.5)])
    parts = [weights, steps_in]
    means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, steps + 1):
        # thresholds stay in order: a first one and positive gaps
        gaps = np.exp(steps_in[1:])
        cuts = np.concatenate([[-np.inf], steps_in[0] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        value = np.bincount(of, share * weights[at], rows)
        below, above = logistic(cuts[grades] - value), logistic(cuts[grades + 1] - value)
        likely = np.maximum(above - below, 1e-12)
        by_below, by_above = -below * (1 - below) / likely, above * (1 - above) / likely
        by_value = (by_below + by_above) * each  # of the negative log likelihood
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grades, -by_below * each)
        np.add.at(by_cut, grades + 1, -by_above * each)
        inner = by_cut[1:-1]
        by_gaps = np.array([inner[k:].sum() for k in range(1, top)]) * gaps
        slopes = [
            np.bincount(at, share * by_value[of], PLACES) + PENALTY * weights / PLACES,
            np.concatenate([[inner.sum()], by_gaps]),
        ]
        for part, mean, square, slope, rate in zip(parts, means, squares, slopes, (0.5, 0.05)):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            part -= rate * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    ends = steps_in[0] + np.concatenate([[0.0], np.cumsum(np.exp(steps_in[1:]))])
    return Model(weights, tuple(float(x) for x in ends))


def fit(docs: DataFrame, labels: DataFrame, grade: str = GRADE, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` documents of each grade at most. Labels of fold 0 are not looked at.

    Without graded documents, or with one grade, the model knows nothing and every tail is a half.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).filter(in_fold() != 0)
    chosen = labelled_sample(texts, labels.filter(in_fold() != 0), grade, sample).select(
        "doc_id", "text", "grade", F.lit("all").alias("one")
    )

    def features(frames):
        for frame in frames:
            found = [counts(text) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "mark": [zlib.crc32(text.encode("utf-8", "surrogatepass")) for text in frame["text"]],
                    "grade": frame["grade"],
                    "at": [np.fromiter(row, "i4", len(row)) for row in found],
                    "share": [np.fromiter(row.values(), "f4", len(row)) for row in found],
                    "one": frame["one"],
                }
            )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "mark"])
        sizes = frame["at"].map(len).to_numpy()
        at, share = (np.concatenate(frame[c].tolist()) for c in ("at", "share"))
        model = fit_shares(sizes, at, share, frame["grade"].to_numpy("i8"))
        used = np.flatnonzero(model.weights)
        at = np.concatenate([used, -1 - np.arange(len(model.thresholds))])
        return pd.DataFrame({"at": at, "value": np.concatenate([model.weights[used], model.thresholds])})

    shares = chosen.mapInPandas(features, "doc_id long, mark long, grade int, at array<int>, share array<float>, one string")
    # one group of a bounded size; its result has PLACES rows at most
    rows = shares.groupBy("one").applyInPandas(run, "at long, value double").collect()
    if not rows:
        return Model(np.zeros(PLACES), (0.0,))
    weights = np.zeros(PLACES)
    for row in rows:
        if row["at"] >= 0:
            weights[row["at"]] = row["value"]
    return Model(weights, tuple(sorted(row["value"] for row in rows if row["at"] < 0)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``expected_grade`` and ``tails``, P(grade >= k) for k from 1.

    Missing and empty texts have the value 0. Columns of these names are replaced.
    """
    tailed = with_text_result(docs, "tails", whole_text(text), "array<double>", lambda: _tails(model))
    kept = [F.col(f"`{c}`") for c in tailed.columns if c.lower() not in ("expected_grade", "tails")]
    total = F.aggregate("tails", F.lit(0.0), lambda a, b: a + b)
    return tailed.select(*kept, total.alias("expected_grade"), "tails")


def _tails(model: Model):
    weigher, width = Weigher(model), len(model.thresholds)

    def run(texts: pa.Array) -> pa.Array:
        values = np.array([weigher.value(t) for t in texts.to_pylist()])
        tails = 1 / (1 + np.exp(np.clip(np.array(model.thresholds)[None, :] - values[:, None], -40, 40)))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), pa.array(tails.ravel()))

    return run


def selected(docs: DataFrame, model: Model, at_least: int = 1, tail: float = 0.5) -> DataFrame:
    """The rows of ``docs`` of which P(grade >= at_least) is ``tail`` or more; columns as they are."""
    columns = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])  # no column has the name of a result
    chosen = scored(numbered, model, f"c{columns.index('text')}").filter(F.element_at("tails", at_least) >= tail)
    return chosen.drop("expected_grade", "tails").toDF(*columns)
