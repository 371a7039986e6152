"""Toxicity of documents by a weighted finite-state grammar over clauses.

Five small transducers each read the classes of a clause's words: insult, threat, target,
negation and reported speech. They are composed once into a single machine, whose states are
tuples of theirs; at the end of a clause its state says what matched (an insult, one aimed at
somebody, one that is denied or reported, a threat), and each kind of match has a weight. A
document's score is the logistic of its weighted matches, so a word counts only by the clause
that it stands in.

What is learned, from labelled documents outside fold 0: which words insult (whole words and
beginnings of words that occur in toxic documents, in many contexts, and hardly in others),
and the weights of the kinds of match. The words of the other classes are fixed.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample, slices, stored, whole_text

#: Labelled documents of each label at most, the share of them that gives words (the rest gives weights).
SAMPLE, WORD_FOLDS = 4_000, (1, 2, 3)
#: A word insults if toxic documents have it in so many contexts, and other documents so much more rarely.
CONTEXTS, RATIO, MOST_WORDS = 8, 20.0, 4_096
BEGINNINGS = (4, 5, 6)
REMEMBERED = 200_000

#: Words of the classes that are not learned, in English, German, French and Spanish.
TARGET = """you your yours yourself he she him her they them their this that those these
du dich dir dein ihr euch er sie ihn ihm tu toi te ton ta vous votre il elle ils elles lui leur
tú ti usted ustedes él ella ellos ellas""".split()
NEGATION = """not no never none nobody isn't aren't don't doesn't won't nicht kein keine nie niemals
ne pas jamais aucun aucune nunca jamás tampoco ningún ninguna""".split()
THREAT = """kill hurt destroy burn beat shoot stab punish regret töten umbringen verletzen schlagen
tuer frapper détruire brûler matar golpear destruir quemar""".split()
REPORT = """said says say told called calls wrote writes quoted claimed reported according
sagte sagt nannte schrieb laut dit disait appelé écrit selon dijo dice llamó escribió según""".split()

OTHER, INSULTS, THREATENS, AIMS, DENIES, REPORTS, END = range(7)
CLASSES = {w: c for c, words in ((AIMS, TARGET), (DENIES, NEGATION), (THREATENS, THREAT), (REPORTS, REPORT)) for w in words}

#: Each transducer as its moves (state, class) -> state; it starts in 0 and stays where no move is given.
#: What it puts out at the end of a clause is its last state.
INSULT_MOVES = {(0, INSULTS): 1, (1, INSULTS): 2}  # none, one, several
THREAT_MOVES = {(0, THREATENS): 1}
TARGET_MOVES = {(0, AIMS): 1}
NEGATION_MOVES = {(0, DENIES): 1, (1, INSULTS): 2, (1, THREATENS): 2}  # 2: something toxic stands behind it
REPORT_MOVES = {(0, REPORTS): 1, (1, INSULTS): 2, (1, THREATENS): 2}
TRANSDUCERS = (INSULT_MOVES, THREAT_MOVES, TARGET_MOVES, NEGATION_MOVES, REPORT_MOVES)

_token = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]").findall


def composed() -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """The product of the transducers: moves[state][class] and, for each state, its tuple."""
    tuples, moves = [(0,) * len(TRANSDUCERS)], []
    numbers = {tuples[0]: 0}
    for now in tuples:  # grows while new states turn up
        row = []
        for kind in range(END):
            to = tuple(moved.get((state, kind), state) for moved, state in zip(TRANSDUCERS, now))
            if to not in numbers:
                numbers[to] = len(tuples)
                tuples.append(to)
            row.append(numbers[to])
        moves.append(row)
    return moves, tuples


MOVES, STATES = composed()
#: Kinds of match: how strong the insult or threat is, whether aimed, denied, reported.
KINDS = list(product(("insult", "insults", "threat"), ("", "aimed"), ("", "denied"), ("", "reported")))


def match(state: tuple[int, ...]) -> int | None:
    """The kind of match that a clause ends with, as its place in ``KINDS``."""
    insult, threat, target, negation, report = state
    if not insult and not (threat and target):  # a threat needs somebody
        return None
    strength = "insults" if insult == 2 else "insult" if insult else "threat"
    kind = (strength, "aimed" * (target > 0), "denied" * (negation == 2), "reported" * (report == 2))
    return KINDS.index(kind)


MATCHES = [match(state) for state in STATES]


@dataclass(frozen=True)
class Model:
    words: frozenset[str]  # whole words end with $
    weights: tuple[float, ...]  # one for each kind, and the constant


class Classes(dict):
    """The class of each word, remembered."""

    def __init__(self, words: frozenset[str]):
        self.words = words

    def __missing__(self, word: str) -> int:
        low = word.lower()
        insults = f"{low}$" in self.words or any(low[:n] in self.words for n in BEGINNINGS if len(low) >= n)
        kind = INSULTS if insults else END if not low[0].isalpha() else CLASSES.get(low, OTHER)
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = kind
        return kind


def matches(text: str, classes: Classes) -> list[int]:
    """How many clauses of a whole text match each kind."""
    found = [0] * len(KINDS)
    kinds = list(map(classes.__getitem__, _token(text)))
    if INSULTS not in kinds and THREATENS not in kinds:
        return found
    state = 0
    for kind in (*kinds, END):
        if kind == END:
            if (what := MATCHES[state]) is not None:
                found[what] += 1
            state = 0
        else:
            state = MOVES[state][kind]
    return found


def _entries(text: str) -> set[tuple[str, int]]:
    """A text's words and beginnings of words, each with the words on both sides as a number."""
    words = [t for t in _token(text.lower()) if t[0].isalpha()]
    found = set()
    for before, word, after in zip(["", *words], words, [*words[1:], ""]):
        context = zlib.crc32(f"{before} {after}".encode())
        found.add((word + "$", context))
        found.update((word[:n], context) for n in BEGINNINGS if len(word) >= n)
    return found


def learned_words(sample: DataFrame) -> frozenset[str]:
    """Words that insult, from ``sample`` (text, grade: 1 toxic): ``MOST_WORDS`` at most, commonest first."""

    def contexts(frames):
        for frame in frames:
            rows = [row for text in frame["text"] for row in _entries(text)]
            yield pd.DataFrame(rows, columns=["entry", "context"])

    toxic = sample.filter("grade = 1").select("text").distinct()
    # copies of one document repeat its contexts, so its own words stay below the bound
    often = toxic.mapInPandas(contexts, "entry string, context long").groupBy("entry").agg(
        F.count_distinct("context").alias("contexts")
    )
    chosen = often.filter(F.col("contexts") >= CONTEXTS).orderBy(F.desc("contexts"), "entry").limit(50 * MOST_WORDS)
    sizes = {row["grade"]: row["n"] for row in sample.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    wanted = frozenset(row["entry"] for row in chosen.select("entry").collect())

    def presence(frames):
        for frame in frames:
            found = [
                (entry, grade)
                for text, grade in zip(frame["text"], frame["grade"])
                for entry in {entry for entry, _ in _entries(text)} & wanted
            ]
            yield pd.DataFrame(found, columns=["entry", "grade"])

    held = sample.select("text", "grade").mapInPandas(presence, "entry string, grade int").groupBy("entry").agg(
        F.sum("grade").alias("toxic"), F.sum(1 - F.col("grade")).alias("other")
    )
    rate_toxic = (F.col("toxic") + 0.5) / (sizes.get(1, 0) + 1)
    rate_other = (F.col("other") + 0.5) / (sizes.get(0, 0) + 1)
    kept = held.filter(rate_toxic / rate_other >= RATIO).orderBy(F.desc("toxic"), "entry").limit(MOST_WORDS)
    return frozenset(row["entry"] for row in kept.collect())


def fit_weights(counts: np.ndarray, toxic: np.ndarray, share: float, steps: int = 400) -> tuple[float, ...]:
    """Logistic regression of the label on log(1 + matches), weights not below 0; ``share``: toxic ones among all."""
    x = np.column_stack([np.log1p(counts), np.ones(len(counts))])
    each = np.where(toxic == 1, share / max(1, (toxic == 1).sum()), (1 - share) / max(1, (toxic == 0).sum()))
    weights = np.zeros(x.shape[1])
    weights[:-1] = 1.0
    weights[-1] = np.log((share + 1e-3) / (1 - share + 1e-3))
    for step in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ ((p - toxic) * each) + 1e-4 * np.append(weights[:-1] - 3.0, 0.0)  # kinds not seen drift to 3
        weights -= 5.0 * slope / (1 + step / 100)
        weights[:-1] = np.maximum(weights[:-1], 0.0)
    return tuple(float(w) for w in weights)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn words and weights from about ``sample`` documents of each label at most. Labels of fold 0 are not looked at.

    Without labelled documents no word insults and every score is a half or less.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).filter(in_fold() != 0)
    once = labels.filter("toxic IS NOT NULL").filter(in_fold() != 0).select("doc_id", "toxic")
    chosen = stored(
        labelled_sample(texts, once, "CAST(toxic AS INT)", sample).select("text", "grade", in_fold().alias("fold")),
        "toxicity-sample",
    )
    words = learned_words(chosen.filter(F.col("fold").isin(*WORD_FOLDS)))
    classes = Classes(words)

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"found": [matches(t, classes) for t in frame["text"]], "grade": frame["grade"]})

    # numbers only, of a bounded sample
    rest = chosen.filter(~F.col("fold").isin(*WORD_FOLDS))
    rows = rest.select("text", "grade").mapInPandas(run, "found array<int>, grade int").collect()
    known = {r["toxic"]: r["count"] for r in once.groupBy("toxic").count().collect()}
    share = known.get(1, 0) / max(1, sum(known.values()))
    if not rows:
        return Model(words, (*[3.0] * len(KINDS), -1.0))
    counts, toxic = np.array([r["found"] for r in rows], float), np.array([r["grade"] for r in rows])
    return Model(words, fit_weights(counts, toxic, min(max(share, 0.01), 0.99)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``score``, 0 to 1, and ``matched``, the clauses of each kind.

    Missing and empty texts match nothing and have the score of the constant alone. Columns
    of these names are replaced.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), whole_text(text).alias("text"))
    out = packed.select("doc", F.lit(0.0).alias("score"), F.array(F.lit(0)).alias("matched")).schema

    def run(batches):
        classes, weights = Classes(model.words), np.array(model.weights)
        for batch in slices(batches):
            found = [matches(t, classes) for t in batch.column("text").to_pylist()]
            sums = np.log1p(np.array(found, float).reshape(-1, len(KINDS))) @ weights[:-1] + weights[-1]
            scores = 1 / (1 + np.exp(-np.clip(sums, -40, 40)))
            kinds = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores), kinds], names=["doc", "score", "matched"])

    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in ("score", "matched")]
    return packed.mapInArrow(run, out).select(*kept, "score", "matched")
