"""Conversations put into the form an optional system turn, then user and assistant in turn.

Rows of a conversation are taken by turn (missing ones first, then by role and the digest of
the text) and edited: kept, given another role, deleted, or with empty rows inserted before
them. The cheapest edits are found by iterative-deepening A*: depth-first in the ASCII order
of the edits' initials, under a cost bound that rises to the least cost that was cut off.
What a state (rows done, last role) still needs at least starts as the faults yet to come; when
a state fails under a bound the table keeps the larger need that this showed, so a later visit
is cut off at once. The first path that is accepted is cheapest, and the ASCII-least of those.

Rows carry no text through the search: a row is two characters, its role and its fault. They
are ordered by a range partitioning, cut into stretches of ``STRETCH`` rows, and each stretch
is searched on its own, so a conversation that holds a large part of the table is spread like
any other. One in a single stretch is done then. Of others a stretch is solved from each state
to each state, and the solutions are chained: paths through the same rows are never prefixes of
each other, so cheapest and ASCII-least pieces make the cheapest, ASCII-least whole. Texts are
shuffled once, sorted, and go past in batches while the edits are carried out on them; only
the finished audit, which is a value of the result, is as long as its conversation.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows of a stretch; a power of two.
STRETCH = 512
#: Costs of edits, and what a truncated row that stays costs on top.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5
#: States: nothing yet, or the role of the last row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row with this initial, and the role that rerole and insert give.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
FINE, BLANK, DUPLICATE, CUT = "0123"
NEVER = 1 << 60
#: Searches of short conversations that a worker remembers: two small strings each.
REMEMBERED, SHORT = 20_000, 32

_BLANKS = " \t\n\x0b\x0c\r"
_ORDER = ("conv_id", "turn", "role", "digest", "copy")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): rows with one of five faults each, by the crc32 of id and turn.

    A missing id or turn counts as one space in the crc32 and stays missing; a missing role or text becomes one space.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    hit = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault"))
    return hit.filter("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _options(codes: str, node: int, open_end: bool) -> list[tuple[str, int, int]]:
    """Edits at a node (rows done times four plus state) as (initial, cost, next node), in ASCII order."""
    at, state = divmod(node, 4)
    if 2 * at == len(codes):
        return [("I", INSERT, 4 * at + GIVEN[state])] if open_end else []
    role, fault = codes[2 * at], codes[2 * at + 1]
    found = [("D", DELETE, node + 4), ("I", INSERT, 4 * at + GIVEN[state])]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if (state, role) in AFTER:
            found.append(("K", KEEP + extra, 4 * at + 4 + AFTER[state, role]))
        found.append(("R", REROLE + extra, 4 * at + 4 + GIVEN[state]))
    return found


def search(codes: str, entry: int = START, leave: int | None = None) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits, the ASCII-least of equal ones; None where there are none.

    ``codes`` has two characters for each row, its role's initial (another role: x) and its
    fault. It starts in state ``entry`` and ends in ``leave`` with the last row; without
    ``leave`` it ends where a conversation may end, with rows inserted after the last as needed.
    """
    rows, open_end = len(codes) // 2, leave is None
    kept_system = any(codes[i] == "s" and codes[i + 1] in (FINE, CUT) for i in range(0, len(codes), 2))
    if (leave == START and entry != START) or (leave == SYSTEM and not (entry == SYSTEM or entry == START and kept_system)):
        return None  # no number of edits leads there
    need = [0] * (4 * rows + 4)
    for at in range(rows - 1, -1, -1):
        ahead = need[4 * at + 4] + (DELETE if codes[2 * at + 1] != FINE else 0)
        need[4 * at : 4 * at + 4] = [ahead] * 4
    goals = {4 * rows + s for s in ((START, ASSISTANT) if open_end else (leave,))}
    if not open_end:
        need[4 * rows :] = [0 if 4 * rows + s in goals else NEVER for s in range(4)]
    options: dict[int, list] = {}

    def of(node):
        if node not in options:
            options[node] = _options(codes, node, open_end)
        return options[node]

    if entry in goals:  # no rows and nothing to do
        return 0, ""
    while (bound := need[entry]) < NEVER:
        path, stack = [], [(entry, bound, iter(of(entry)))]
        while stack:
            node, left, untried = stack[-1]
            for initial, cost, to in untried:
                if cost + need[to] <= left:
                    path.append(initial)
                    if to in goals:
                        return bound, "".join(path)
                    stack.append((to, left - cost, iter(of(to))))
                    break
            else:
                need[node] = max(need[node], min((cost + need[to] for _, cost, to in of(node)), default=NEVER))
                stack.pop()
                if path:
                    path.pop()
    return None


_remembered = lru_cache(REMEMBERED)(search)


def _solved(codes: str, entry: int, leave: int | None) -> tuple[int, str] | None:
    return (_remembered if len(codes) <= 2 * SHORT else search)(codes, entry, leave)


def _same(name: str = "conv_id") -> Column:
    return F.col(name).eqNullSafe(F.col(f"_{name}"))


def placed(rows: DataFrame) -> DataFrame:
    """Rows without text in order: (conv_id, turn, role, digest, copy, blank, cut, place), place ascending."""
    trimmed = F.btrim("text", F.lit(_BLANKS))
    light = rows.select(
        "conv_id",
        "turn",
        "role",
        F.sha2("text", 256).alias("digest"),
        "copy",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    ordered = light.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return stored(ordered.withColumn("place", F.monotonically_increasing_id()), "conversation-rows")


def coded(places: DataFrame) -> DataFrame:
    """``placed`` with ``code``, the initial of the role and the first fault of a row."""
    seen = places.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    seen = seen.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "first")
    # rows said over and over are hot on one side only, which adaptive execution splits
    joined = places.join(seen, _same() & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")), "left")
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("place") > F.col("first"), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    )
    return joined.select("conv_id", "place", F.concat(role, fault).alias("code"))


_PIECES = (
    "conv_id {id}, stretch bigint, opens boolean, closes boolean, codes string, "
    "entries array<int>, leaves array<int>, costs array<bigint>, audits array<string>, ranks array<int>"
)


def stretches(codes: DataFrame, size: int = STRETCH) -> DataFrame:
    """Each conversation's stretches of ``size`` rows at most, solved from each state to each state that matters."""
    stretch = F.expr(f"place DIV {size}").alias("stretch")
    parts = codes.groupBy("conv_id", stretch).agg(F.collect_list(F.struct("place", "code")).alias("rows"))
    parts = parts.select("conv_id", "stretch", F.array_join(F.transform(F.array_sort("rows"), lambda r: r.code), "").alias("codes"))
    spans = codes.select("conv_id", stretch).groupBy("conv_id").agg(F.min("stretch").alias("a"), F.max("stretch").alias("b"))
    spans = spans.filter("a < b").withColumnRenamed("conv_id", "_conv_id")
    ends = parts.join(spans, _same(), "left").select(
        "conv_id",
        "stretch",
        "codes",
        (F.coalesce("a", "stretch") == F.col("stretch")).alias("opens"),
        (F.coalesce("b", "stretch") == F.col("stretch")).alias("closes"),
    )

    def run(frames):
        for frame in frames:
            solved = []
            for codes, opens, closes in zip(frame["codes"], frame["opens"], frame["closes"]):
                found = []
                for entry in (START,) if opens else range(4):
                    ways = [(leave, _solved(codes, entry, leave)) for leave in ((None,) if closes else range(4))]
                    audits = sorted(way[1] for _, way in ways if way)
                    found += [(entry, -1 if leave is None else leave, *way, audits.index(way[1])) for leave, way in ways if way]
                solved.append([list(column) for column in zip(*found)])
            names = ("entries", "leaves", "costs", "audits", "ranks")
            yield pd.concat(
                [frame[["conv_id", "stretch", "opens", "closes", "codes"]].reset_index(drop=True),
                 pd.DataFrame({name: [s[i] for s in solved] for i, name in enumerate(names)}, dtype=object)],
                axis=1,
            )

    kind = dict(codes.dtypes)["conv_id"]
    return stored(ends.mapInPandas(run, _PIECES.format(id=kind)), "conversation-stretches")


def chained(pieces: DataFrame) -> DataFrame:
    """(conv_id, stretch, chosen): which solution of each stretch is part of the whole, as its place in the lists.

    Goes through the stretches of a conversation in order with the best way into each state.
    Of equal costs the ASCII-least way is that with the lower rank: first of the way so far, then in the stretch.
    """
    kind = dict(pieces.dtypes)["conv_id"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("stretch", ignore_index=True)
        ways, back = {START: (0, 0)}, []  # state -> cost, rank of the way there among all of the same rows
        for entries, leaves, costs, ranks in zip(frame["entries"], frame["leaves"], frame["costs"], frame["ranks"]):
            best = {}
            for i, (entry, leave, cost, rank) in enumerate(zip(entries, leaves, costs, ranks)):
                if entry in ways:
                    so_far, before = ways[entry]
                    way = (so_far + cost, before, rank, i, entry)
                    best[leave] = min(best.get(leave, way), way)
            order = sorted((before, rank) for _, before, rank, _, _ in best.values())
            ways = {leave: (way[0], order.index(way[1:3])) for leave, way in best.items()}
            back.append({leave: way[3:] for leave, way in best.items()})
        chosen, state = [0] * len(back), -1
        for at in range(len(back) - 1, -1, -1):
            chosen[at], state = back[at][state]
        return pd.DataFrame({"conv_id": frame["conv_id"], "stretch": frame["stretch"], "chosen": chosen})

    light = pieces.select("conv_id", "stretch", "entries", "leaves", "costs", "ranks")
    return light.groupBy("conv_id").applyInPandas(run, f"conv_id {kind}, stretch bigint, chosen int")


def _within(codes: DataFrame) -> list[Column]:
    """Counts within a stretch's codes."""
    count = lambda fault: F.length(F.translate("codes", "0123suax".replace(fault, ""), "")).cast("bigint")
    roles = F.translate("codes", "0123", "")
    pairs = F.transform(F.sequence(F.lit(1), F.length(roles) - 1), lambda i: F.substring(roles, i, F.lit(2)))
    illegal = F.when(F.length(roles) < 2, 0).otherwise(F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL))))
    return [
        count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT).alias("truncated"),
        illegal.cast("bigint").alias("illegal"),
        F.substring(roles, 1, 1).alias("first"), F.right(roles, F.lit(1)).alias("last"),
    ]


def audits(rows: DataFrame, size: int = STRETCH) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, copy): its faults and cheapest edits.

    ``gaps`` is null where it does not fit a long.
    """
    places = placed(rows)
    pieces = stretches(coded(places), size)
    chosen = chained(pieces.filter("NOT (opens AND closes)"))
    chosen = chosen.select(F.col("conv_id").alias("_conv_id"), F.col("stretch").alias("_stretch"), "chosen")
    picked = pieces.join(chosen, _same() & (F.col("stretch") == F.col("_stretch")), "left").select(
        "conv_id", "stretch", *_within(pieces),
        F.get("costs", F.coalesce("chosen", F.lit(0))).alias("cost"),
        F.get("audits", F.coalesce("chosen", F.lit(0))).alias("audit"),
    )
    before = F.lag("last").over(Window.partitionBy("conv_id").orderBy("stretch"))  # a row for each stretch
    met = F.concat(before, F.col("first"))
    seams = F.when(met.isNotNull() & ~met.isin(*LEGAL), 1).otherwise(0)
    summed = picked.withColumn("seam", seams).groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + F.col("seam")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("stretch", "audit"))), lambda r: r.audit), "").alias("audit"),
    )
    turns = places.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        (F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count("turn")).alias("span"),
        F.count("turn").alias("n"),
    )
    turns = turns.select(F.col("conv_id").alias("_conv_id"), F.when(F.col("n") == 0, 0).otherwise(F.col("span").try_cast("bigint")).alias("gaps"))
    return summed.join(turns, _same()).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, role, text): the rows with the ``edits`` (conv_id, audit) carried out, in order.

    A conversation is in one partition, its rows one after the other; they are sorted there, not gathered.
    """
    kind = dict(rows.dtypes)["conv_id"]
    turn, copy = (dict(rows.dtypes)[c] for c in ("turn", "copy"))
    ahead = edits.select(
        "conv_id", F.lit(0).alias("is_row"), F.lit(None).cast(turn).alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("digest"), F.lit(0).cast(copy).alias("copy"), F.col("audit").alias("text"),
    )
    each = rows.select("conv_id", F.lit(1).alias("is_row"), "turn", "role", F.sha2("text", 256).alias("digest"), "copy", "text")
    ordered = ahead.unionByName(each).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *_ORDER[1:])

    def run(batches):
        audit, at, state = "", 0, START
        conversation = None

        def inserts(out):
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = GIVEN[state]
                out.append((conversation, ROLE[state], ""))
                at += 1

        schema = None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "is_row", "role", "text"))
            for conv, is_row, role, text in zip(*columns):
                if not is_row:
                    inserts(out)  # what the one before ends with
                    conversation, audit, at, state = conv, text, 0, START
                    continue
                inserts(out)
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = AFTER[state, role[0]]
                    out.append((conv, role, text))
                elif edit == "R":
                    state = GIVEN[state]
                    out.append((conv, ROLE[state], text))
            yield _table(out, schema)
        if schema is not None:
            out = []
            inserts(out)
            yield _table(out, schema)

    return ordered.select("conv_id", "is_row", "role", "text").mapInArrow(run, f"conv_id {kind}, role string, text string")


def _table(out: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    ids, roles, texts = zip(*out) if out else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, conv), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["conv_id", "role", "text"]
    )


def digests(done: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows as they come: of ``role:text``, joined by line ends."""
    kind = dict(done.dtypes)["conv_id"]

    def run(batches):
        running, conversation, schema = None, None, None
        for batch in batches:
            schema, out = batch.schema.field("conv_id").type, []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if running is None or conv != conversation:
                    out += [(conversation, running.hexdigest())] if running else []
                    running, conversation = hashlib.sha256(), conv
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield _pair(out, schema)
        if running:
            yield _pair([(conversation, running.hexdigest())], schema)

    return done.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def _pair(out: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    ids, sums = zip(*out) if out else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, conv), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])


def repair_report(conversations: DataFrame, rows: DataFrame, size: int = STRETCH) -> DataFrame:
    """Every conv_id of ``conversations`` with faults, edits and the digest of its repaired ``rows``.

    Rows without conv_id are one conversation. One without rows has zeros, an empty audit and
    the digest of nothing. Repeated rows are duplicates; rows alike in turn are ordered by role
    and text digest. Other columns do not matter; an empty table gives an empty result.
    """
    found = stored(audits(rows, size), "conversation-audits")
    sums = digests(repaired(rows, found.select("conv_id", "audit"))).withColumnRenamed("conv_id", "_conv_id")
    whole = found.join(sums, _same(), "left").drop("_conv_id").withColumnRenamed("conv_id", "_conv_id")
    every = conversations.select("conv_id").distinct().join(whole, _same(), "left").drop("_conv_id")
    numbers = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.when(F.col("audit").isNull(), 0).otherwise(F.col("gaps")).cast("bigint")
    return every.select(
        "conv_id", gaps.alias("gaps"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
