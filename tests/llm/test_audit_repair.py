"""Repair of conversations against a search through all lists of edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from quittance.llm import audit_repair as ar
from quittance.llm.common import table

VALID = re.compile(r"(s?(ua)+)?")
BEGUN = re.compile(r"(s?(ua)*u?)?")
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    """Rows after the damage, by conversation; conversations without rows have an empty list."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        found[conv_id] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for listed in found.values():
        listed.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return found


def faults_of(listed):
    seen, found = set(), []
    for _, role, text in listed:
        solid = text.strip(BLANK)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        found.append(fault)
    return found


def cheapest(rows, faults):
    """All lists of edits that cost no more than deleting every row, pruned by what roles they give."""
    best = [(2 * len(rows) + 5 * 0, "D" * len(rows), ())]

    def go(i, initials, cost, audit, said):
        if cost > best[0][0] or not BEGUN.fullmatch(initials):
            return
        if i == len(rows) and VALID.fullmatch(initials):
            best[0] = min(best[0], (cost, audit, said))
        for name in ("user", "assistant"):
            go(i, initials + name[0], cost + 5, audit + "I", (*said, f"{name}:"))
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, initials, cost + 2, audit + "D", said)
        if faults[i] not in ("blank", "duplicate"):
            more = 5 if faults[i] else 0
            if role[:1] in ("s", "u", "a"):
                go(i + 1, initials + role[0], cost + more, audit + "K", (*said, f"{role}:{text}"))
            for name in ("user", "assistant"):
                go(i + 1, initials + name[0], cost + 1 + more, audit + "R", (*said, f"{name}:{text}"))

    go(0, "", 0, "", ())
    return best[0]


def expected(rows):
    found = {}
    for conv_id, listed in damaged(rows).items():
        faults = faults_of(listed)
        cost, audit, said = cheapest(listed, faults)
        turns = [t for t, _, _ in listed if t is not None]
        initials = [r[:1] for _, r, _ in listed]
        found[conv_id] = (
            conv_id,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost,
            audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return found


def awkward():
    rnd = random.Random(3)
    texts = ["Yes.", "No!", "Why?", "an open end", "", " \t\n", "same.", "ü. \n", "x" * 30_000 + ".", None]
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "", None, "ux", "über"]
    found = []
    for conv_id in [*range(40), None]:
        for i in range(rnd.randint(1, 7)):
            turn = rnd.choice([i, i, i, i + 3, None, -i])
            found.append((conv_id, turn, rnd.choice(roles), rnd.choice(texts)))
    found += [found[0]] * 3
    for conv_id in range(100, 160):  # one row each, so that some are dropped
        found.append((conv_id, 1, "user", "Hello."))
    return found


@pytest.mark.parametrize("block", [1, 3, ar.BLOCK])
def test_awkward_conversations(spark, block):
    rows = awkward()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    frame = frame.select("*", *[F.lit("x").alias(c) for c in ("kind", "digest", "copies", "part", "first", "c", "is_text")])
    found = {r["conv_id"]: tuple(r) for r in ar.repair(ar.damage(frame), block).collect()}
    assert found == expected(rows)
    assert ar.damage_and_repair(frame.where("false")).count() == 0


def test_the_given_conversations(spark):
    frame = table(spark, TESTDATA, "conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert {r["conv_id"]: tuple(r) for r in ar.damage_and_repair(frame).collect()} == expected(rows)


def whole_texts(symbols):
    """The same search with whole texts instead of linked nodes."""
    best = {ar.START: (0, "")}
    for symbol in symbols:
        found = {}
        for state, (cost, text) in best.items():
            for end, (price, label) in ar.ROW_TABLES[symbol][state].items():
                way = (cost + price, text + label)
                found[end] = min(found.get(end, way), way)
        best = found
    return best


@pytest.mark.parametrize("prime", [ar._PRIME, 2, 7])
def test_linked_ways_compare_like_texts_even_if_hashes_collide(prime):
    rnd = random.Random(prime)
    for _ in range(60):
        symbols = rnd.choices("suaoSUAOx", k=rnd.randint(0, 200))
        fold = ar.Fold(ar.START)
        fold.ways = ar.Ways(prime)
        for symbol in symbols:
            fold.add(ar.ROW_TABLES[symbol])
        assert fold.texts() == whole_texts(symbols)


def test_tables_of_pieces_fold_like_rows():
    rnd = random.Random(8)
    symbols = "".join(rnd.choices("suaoSUAOx", k=3000))
    whole, start = ar.Fold(ar.START), 0
    while start < len(symbols):
        size = rnd.randint(1, 200)
        whole.add(ar.fold_rows(symbols[start : start + size], tuple(ar.STATES)))
        start += size
    assert whole.texts() == ar.fold_rows(symbols)[ar.START] == whole_texts(symbols)


def test_a_conversation_over_many_partitions(spark):
    rnd = random.Random(9)
    rows = [(7, t, rnd.choice(["user", "assistant"]), f"Text {rnd.randint(0, 2000)}" + rnd.choice([".", ""])) for t in range(6000)]
    frame = spark.createDataFrame([*rows, (6, 0, "user", "a."), (8, 0, "user", "b.")], "conv_id long, turn long, role string, text string")
    result = {r["conv_id"]: r for r in ar.repair(ar.damage(frame), 500).collect()}
    listed = damaged(rows)[7]
    faults = faults_of(listed)
    symbols = [
        ar.GONE if f in ("blank", "duplicate") else r[0].upper() if f else r[0] for (_, r, _), f in zip(listed, faults, strict=True)
    ]
    assert (result[7]["cost"], result[7]["audit"]) == ar.finish(whole_texts(symbols))
    assert [result[7][f] for f in ("blank", "duplicate", "truncated")] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    assert set(result) == {6, 7, 8}
