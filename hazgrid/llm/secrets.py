"""Secrets in texts: three fixed patterns, and character Markov models for what they miss.

Two first-order Markov models over the characters of a token are trained: one on strings known
to be random (what the patterns found), one on ordinary words and identifiers, both over all
documents. Long tokens are cut where a pattern's match begins or ends; a part that no pattern covers is
reported when its log-likelihood ratio, summed over its characters, reaches ``MARGIN``, and else the stretch of it
with the largest sum, if that does. So a random string is found behind an ordinary name, or next to a match.

DataFrame and SQL functions only. Places come from the texts between the matches: ``split``
gives them, and their lengths add up to where each match starts, in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text

#: The kinds in order, their patterns, and the characters that each needs besides.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is too short fails whole, and so does every part of it; so the length is part of the pattern.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
LEAST_VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Characters of a token, a part of it, and a stretch that are judged, at least.
LEAST_TOKEN = 16
#: A token to be judged, and an ordinary one to learn from.
TOKEN, ORDINARY = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_TOKEN, r"[A-Za-z_][A-Za-z0-9_]{3,}"
#: Nats by which a stretch must look random rather than ordinary.
MARGIN = 12.0

SPAN = "struct<start:int,end:int,kind:int,value:string>"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans(pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """The matches of ``pattern`` in ``text`` as an array of ``SPAN``, leftmost first; ``value`` is ``group``."""
    p = _literal(pattern)
    found, value = f"regexp_extract_all(text, {p}, 0)", f"regexp_extract_all(text, {p}, {group})"
    # fields 0, 1, 2: the text before a match, the match, its value
    walk = f"""
    aggregate(
      arrays_zip(slice(split(text, {p}, -1), 1, size({found})), {found}, {value}),
      named_struct('at', 0, 'out', CAST(array() AS array<{SPAN}>)),
      (acc, x) -> named_struct(
        'at', acc.at + length(x.`0`) + length(x.`1`),
        'out', IF(length(x.`2`) < {least}, acc.out, concat(acc.out, array(named_struct(
          'start', acc.at + length(x.`0`), 'end', acc.at + length(x.`0`) + length(x.`1`),
          'kind', {kind}, 'value', x.`2`))))),
      acc -> acc.out)"""
    return F.expr(f"IF(text RLIKE {p}, {walk}, CAST(array() AS array<{SPAN}>))")


def base(rows: DataFrame) -> DataFrame:
    """``rows`` (text, ...) with ``known``, the spans of the three patterns, and ``tokens``, what these leave of long ones."""
    each = rows.select(
        "*",
        spans(ASSIGN, 0, 2, LEAST_VALUE).alias("assigned"),
        spans(ACCESS, 1).alias("accessed"),
        spans(HEX, 2).alias("hexed"),
        spans(TOKEN, 3).alias("long"),
    )
    joined = each.select("*", F.concat("assigned", "accessed", "hexed").alias("known"))
    return joined.select("*", F.expr(_CLEAR).alias("tokens")).drop("assigned", "accessed", "hexed", "long")


#: Long tokens without the spans that they meet: parts begin at a token's start or a span's end, unless within another span.
_CLEAR = f"""
flatten(transform(
  transform(long, t -> named_struct('t', t, 'near', filter(known, k -> k.start < t.end AND t.start < k.end))),
  x -> IF(size(x.near) = 0, array(x.t), filter(
    transform(
      filter(
        array_distinct(concat(array(x.t.start), transform(x.near, k -> k.end))),
        s -> s < x.t.end AND NOT exists(x.near, k -> k.start <= s AND s < k.end)),
      s -> transform(
        array(coalesce(array_min(transform(filter(x.near, k -> k.start >= s), k -> k.start)), x.t.end)),
        e -> named_struct('start', s, 'end', e, 'kind', x.t.kind,
          'value', substr(x.t.value, s - x.t.start + 1, e - s)))[0]),
    part -> part.end - part.start >= {LEAST_TOKEN}))))"""


def _transitions(tokens: DataFrame) -> dict[tuple[str, str], int]:
    """How often a character follows another in the ``token`` column.

    Equal tokens are looked at once and count as often as they occur. Tasks add up their own tokens and
    pairs first; the few characters that the patterns allow bound the result.
    """
    letters = tokens.groupBy("token").count().select(F.split("token", "").alias("c"), "count")
    pairs = "transform(sequence(1, size(c) - 1), i -> concat(c[i - 1], c[i]))"
    each = letters.filter(F.size("c") > 1).select(F.explode(F.expr(pairs)).alias("pair"), "count")
    return {tuple(row["pair"]): row["n"] for row in each.groupBy("pair").agg(F.sum("count").alias("n")).collect()}


def _log_probabilities(counts: dict[tuple[str, str], int]) -> list[list[float]]:
    """For each character the log-probabilities of the next, every transition seen half a time beforehand."""
    table = []
    for a in ALPHABET:
        row = [counts.get((a, b), 0) + 0.5 for b in ALPHABET]
        total = sum(row)
        table.append([math.log(n / total) for n in row])
    return table


def train(known: DataFrame, texts: DataFrame) -> list[list[float]]:
    """The table of log-likelihood ratios, random over ordinary, for each character and its next.

    Random strings are the values found by the patterns in all of ``known`` (known); ordinary
    tokens are those of all rows of ``texts`` (text), without what the patterns match; repeated
    rows count in both. With nothing to learn from, a model is uniform; the random one is half uniform anyway.
    """
    random = _transitions(known.select(F.explode("known.value").alias("token")))
    plain = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = texts.select(F.explode(F.regexp_extract_all(plain, F.lit(ORDINARY), F.lit(0))).alias("token"))
    a, b = _log_probabilities(random), _log_probabilities(_transitions(words))
    # random strings of other alphabets than those found are as likely again
    other = 1 / len(ALPHABET)
    return [[math.log((math.exp(x) + other) / 2) - y for x, y in zip(p, q)] for p, q in zip(a, b)]


def likely_random(tokens: str, table: list[list[float]], margin: float = MARGIN) -> Column:
    """Those of the column ``tokens`` (array of ``SPAN``) whose sum of ratios reaches the margin; of others the best stretch that does.

    A sum that falls below zero is given up, and a new stretch begins at the next character; of equal sums the first
    counts. A stretch of fewer than ``LEAST_TOKEN`` characters is none.
    """
    cells = ",".join(f"{x:.5f}" for row in table for x in row)
    size = len(ALPHABET)
    # a stretch is known by the numbers of its first and last character
    ratio = f"""
    aggregate(
      slice(split(t.value, ''), 2, length(t.value)),
      named_struct('total', 0D, 'sum', 0D, 'from', 0, 'at', 0, 'best', 0D, 'first', 0, 'to', 0,
        'last', instr('{ALPHABET}', substr(t.value, 1, 1))),
      (acc, c) -> transform(
        array(element_at(cell, (acc.last - 1) * {size} + instr('{ALPHABET}', c))),
        step -> named_struct(
          'total', acc.total + step, 'sum', greatest(acc.sum + step, 0D),
          'from', IF(acc.sum + step > 0, acc.from, acc.at + 1), 'at', acc.at + 1,
          'best', greatest(acc.best, acc.sum + step), 'first', IF(acc.sum + step > acc.best, acc.from, acc.first),
          'to', IF(acc.sum + step > acc.best, acc.at + 1, acc.to), 'last', instr('{ALPHABET}', c)))[0],
      acc -> IF(acc.total >= {margin}, named_struct('best', acc.total, 'start', t.start, 'end', t.end),
        named_struct('best', acc.best, 'start', t.start + acc.first, 'end', t.start + acc.to + 1)))"""
    # the table is a literal: split and cast are folded when the query is planned
    ratio = ratio.replace("cell", f"CAST(split('{cells}', ',') AS array<double>)")
    stretches = f"filter(transform({tokens}, t -> {ratio}), s -> s.best >= {margin} AND s.end - s.start >= {LEAST_TOKEN})"
    kind = len(KINDS) - 1
    return F.expr(f"transform({stretches}, s -> named_struct('start', s.start, 'end', s.end, 'kind', {kind}, 'value', ''))")


def scan(docs: DataFrame, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row (doc_id, spans) for each row of ``docs``: an array of (start, end, kind) by start, then kind.

    ``kind`` is one of ``KINDS``, places are code points, the end exclusive. A missing text has
    no spans; so have all rows of a table without long or assigned values. Other columns of
    ``docs`` are not looked at, repeated rows each get a row.
    """
    rows = docs.select("doc_id", whole_text(text).alias("text"))
    found = stored(base(rows).drop("text"), "secret-spans")
    table = train(found, rows.select("text"))
    every = F.concat("known", likely_random("tokens", table, margin))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s.start, s.end, s.kind)), _by_start_then_kind)
    names = F.array(*map(F.lit, KINDS))
    named = F.transform("spans", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), names[s.kind].alias("kind")))
    return found.select("doc_id", ordered.alias("spans")).select("doc_id", named.alias("spans"))


def _by_start_then_kind(a: Column, b: Column) -> Column:
    order = lambda s: s["start"].cast("bigint") * 8 + s["kind"]
    return F.signum(order(a) - order(b)).cast("int")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
