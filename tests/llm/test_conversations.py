"""Edits and repaired conversations against a search through all edits, and plain Python end to end."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from hazgrid.llm import conversations, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place string, digest string, code string"


def cheapest(rows):
    """(cost, audit) by dynamic programming over whole suffixes; rows are (initial, fault)."""
    allowed = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    forced = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(at, last, inserted):
        ways = [(0, "")] if at == len(rows) and last in ("", "a") else []

        def add(cost, letter, rest):
            if rest:
                ways.append((cost + rest[0], letter + rest[1]))

        if inserted < 2:
            add(5, "I", best(at, forced[last], inserted + 1))
        if at < len(rows):
            initial, fault = rows[at]
            add(2, "D", best(at + 1, last, 0))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if (last, initial) in allowed:
                    add(extra, "K", best(at + 1, allowed[last, initial], 0))
                add(1 + extra, "R", best(at + 1, forced[last], 0))
        return min(ways) if ways else None

    return best(0, "", 0)


def by_hand(table):
    """The contract, one conversation after the other."""
    out, of = {}, {}
    for conv, turn, role, text in table:
        of.setdefault(conv, [])
        name = lambda v: " " if v is None else str(v)
        role, text = name(role), name(text)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        of[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv, rows in of.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in rows:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append(
                "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None
            )
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in rows]
        turns = {t for t, _, _ in rows if t is not None}
        cost, audit = cheapest([*zip(initials, faults)])
        done, state, left = [], "", iter(rows)
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "K":
                done.append(f"{row[1]}:{row[2]}")
                state = row[1][0]
            elif edit in "IR":
                state = "a" if state == "u" else "u"
                done.append(("user" if state == "u" else "assistant") + ":" + ("" if edit == "I" else row[2]))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest(),
        )
    return out


def rows_of(found):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = found.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in names) for r in rows}


def random_codes(rng, rows):
    return "".join(rng.choice("suuuaaax") + rng.choice("00000123") for _ in range(rows))


@pytest.mark.parametrize("seed", range(6))
def test_search_is_cheapest_and_least(seed):
    rng, names = random.Random(seed), {"0": None, "1": "blank", "2": "duplicate", "3": "truncated"}
    for _ in range(150):
        codes = random_codes(rng, rng.randrange(9))
        assert conversations.search(codes) == cheapest([(codes[i], names[codes[i + 1]]) for i in range(0, len(codes), 2)])


def test_pieces_make_the_whole(spark):
    """Conversations cut into stretches of two rows have the same edits as whole ones."""
    rng, rows = random.Random(3), []
    for conv in range(60):
        for turn in range(rng.randrange(40)):
            text = rng.choice(["Yes.", "No", "", "Why?", f"Because {turn}.", f"And {turn}"])
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "tool"]), text))
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    wanted = by_hand(rows)
    for size in (2, conversations.STRETCH):
        assert rows_of(conversations.repair_report(docs, conversations.damaged(docs), size)) == wanted


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (1, None, None, "text."),
        (1, None, "user", None), (1, -5, "", "."), (1, 7, "user", "a\nb."), (1, 7, "assistant", "é!"), (2, 3, "user", " \t\x0b "),
        (3, 0, "system", "S."), (4, 9, "User", "U."), (5, 1, "user", "long " * 50_000 + "."), (5, 2, "assistant", "\x1c"),
        (6, None, "user", "a."), (6, None, "user", "a."), (7, 1, "assistant", "Tie."), (7, 1, "user", "Tie."), (7, 1, "user", "Tie 2."),
    ]
    rows += [(8, i, "user" if i % 2 else "assistant", "Same.") for i in range(40)]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert rows_of(conversations.repair_report(docs, conversations.damaged(docs))) == by_hand(rows)


def test_dropped_conversations_and_far_turns(spark):
    gone = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    rows = [(i, 0, "user", "Gone.") for i in gone] + [(1_000, 2**63 - 1, "user", "A."), (1_000, -(2**63), "user", "B.")]
    found = rows_of(conversations.repair_report(*(lambda d: (d, conversations.damaged(d)))(
        spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA))))
    for i in gone:
        assert found[i] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert found[1_000][0] is None


def test_repaired_rows_have_the_form(spark, sf_dir):
    rows = conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    edits = conversations.audits(rows)
    done = {}
    for r in conversations.repaired(rows, edits.select("conv_id", "audit")).collect():
        done[r.conv_id] = done.get(r.conv_id, "") + r.role[0]
    assert done and all(re.fullmatch("s?(ua)+", roles) for roles in done.values())


def test_one_conversation_of_most_rows(spark):
    """Stretches of one large conversation are solved in many tasks."""
    rng = random.Random(8)
    rows = [(1, i, ("user", "assistant")[i % 2], rng.choice(["Yes.", f"Well {i}.", "Oh"])) for i in range(6_000)]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(8)
    damaged = conversations.damaged(docs)
    pieces = conversations.stretches(conversations.coded(conversations.placed(damaged)), 64)
    assert pieces.count() > 80
    row = conversations.repair_report(docs, damaged, 64).first()
    whole = conversations.audits(damaged, 1 << 20).first()
    assert (row.cost, row.audit) == (whole.cost, whole.audit)


def test_empty_table(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/conversations.parquet").filter("false")
    assert conversations.repair_report(none, conversations.damaged(none)).count() == 0


def test_query_against_plain_python(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op13_conversation_repair(spark, sf_dir)) == by_hand(rows)
