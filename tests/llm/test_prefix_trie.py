"""The prefix trie against one built from whole turns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from quittance.llm import prefix_trie as pt
from quittance.llm.common import table


def rebuilt(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
        turns[conv_id].append((turn is not None, turn or 0, key, role, text))
    told = {c: [t[3:] for t in sorted(listed)] for c, listed in turns.items()}
    found = {}
    for c, own in told.items():
        h = zlib.crc32(str(c if c is not None else "").encode()) % 9
        base = told.get(c - c % 5, []) if c is not None else []
        found[c] = base[:h] + own[h:]
    return found


def plain(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    least = {n: min((c for c in ids if c is not None), default=None) for n, ids in members.items()}
    children = Counter(n[:-1] for n in members if n)
    saved = {n: (len(ids) - 1) * (len(n[-1][1].encode()) if n else 0) for n, ids in members.items()}
    leaves, below = Counter(), Counter()
    for n in members:
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            below[n[:d]] += saved[n]
    found = Counter()
    for n, ids in members.items():
        ends = sorted((c for c in ids if len(conversations[c]) == len(n)), key=lambda c: (c is not None, c or 0))
        listed = ",".join("" if c is None else str(c) for c in ends)
        parent = least[n[:-1]] if n else None
        row = (least[n], len(n), parent, len(ids), children[n], leaves[n], below[n], hashlib.sha256(listed.encode()).hexdigest())
        found[row] += 1
    return found


def awkward():
    rnd = random.Random(13)
    texts = ["a", "b", "ü", "", None, "x" * 30_000]
    found = []
    for c in [*range(0, 120), 1_000_003, None]:
        if c in (20, 45):  # absent bases
            continue
        for i in range(rnd.choice([1, 2, 3, 5, 9, 12, 30])):
            found.append((c, rnd.choice([i, i, i, None]), rnd.choice(["user", "assistant", None]), rnd.choice(texts)))
    same = [(i, ["user", "assistant"][i % 2], "the same") for i in range(11)]
    for c in range(200, 330):  # one conversation many times
        found += [(c, *turn) for turn in same]
    return found + found[:4]


@pytest.mark.parametrize("partitions, fan", [("1", 64), ("7", 64), ("40", 3)])
def test_awkward_conversations(spark, monkeypatch, partitions, fan):
    monkeypatch.setattr(pt, "FAN", fan)
    monkeypatch.setattr(pt, "PIECE", 60)
    rows = awkward()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    frame = frame.select("*", *[F.lit("x").alias(c) for c in ("base", "path", "kind", "node", "part", "turns", "ends")])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = Counter(tuple(r) for r in pt.shared_beginnings(frame).collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found == plain(rebuilt(rows))


def test_an_empty_table_has_no_root(spark):
    assert pt.shared_beginnings(table(spark, TESTDATA, "conversations").where("false")).count() == 0


def test_the_given_conversations(spark):
    frame = table(spark, TESTDATA, "conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r) for r in pt.shared_beginnings(frame).collect()) == plain(rebuilt(rows))


def forest(paths, parts):
    """The trie of paths dealt to so many forests in a row."""
    listed = sorted(paths.items(), key=lambda p: p[1])
    closed, left = [], []
    bounds = [round(i * len(listed) / parts) for i in range(parts + 1)]
    for part, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        groups = [pt.Group(path, [1] * (len(path) // pt.STEP), 1, c, str(c)) for c, path in listed[a:b]]
        for row in pt.Forest(groups, part).build() if groups else []:
            (left if row["kind"] == pt.OPEN else closed).append(row)
    return closed, [r | {"n_leaves": r["n_leaves"], "ends_sha256": r["ends_sha256"]} for r in left]


def test_forests_merge_to_the_same_nodes_however_they_are_cut():
    rnd = random.Random(4)
    paths, seen = {}, set()
    while len(paths) < 200:
        path = b"".join(bytes([rnd.choice(b"abc")]) * pt.STEP for _ in range(rnd.randint(0, 7)))
        if path not in seen:
            seen.add(path)
            paths[len(paths)] = path
    rows = lambda found: Counter((r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in found)
    whole = None
    for parts in (1, 2, 9, 200):
        closed, left = forest(paths, parts)
        found = rows(closed + pt.merge_forests(left, 0, True))
        whole = whole or found
        assert found == whole
    assert sum(whole.values()) == len({p[: d * pt.STEP] for p in paths.values() for d in range(len(p) // pt.STEP + 1)})
