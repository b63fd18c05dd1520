"""Sharding on tables with large groups, equal rows and values with a common beginning."""

import random
import zlib
from collections import Counter, defaultdict
from math import log2

import pytest
from pyspark.sql import functions as F

from quittance.llm import kd_shards as kd
from quittance.llm.common import table

SF = "/root/testdata/sf0.01"


def placed(docs, shards=kd.SHARDS):
    """Sizes, slots and texts of each shard."""
    found = kd.assign(docs, shards).collect()
    sizes, slots, texts = Counter(), defaultdict(list), defaultdict(set)
    weights = Counter()
    for r in found:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        texts[r.text_crc32, r.size].add(r.shard)
        weights[r.text_crc32, r.size] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, texts, weights


def test_no_group_that_fits_a_shard_is_split_and_sizes_are_near(spark):
    sizes, texts, weights = placed(table(spark, SF, "documents"))
    share = sum(sizes.values()) / kd.SHARDS
    assert sorted(sizes) == list(range(kd.SHARDS))
    assert [g for g, shards in texts.items() if len(shards) > 1 and weights[g] <= share] == []
    assert max(abs(s - share) for s in sizes.values()) < 0.03 * share


def test_equal_rows_without_an_id_spread_over_shards(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    text = "the same row " * 38
    again = spark.range(3000).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source")
    )
    sizes, texts, _ = placed(docs.unionByName(again))
    share = sum(sizes.values()) / kd.SHARDS
    assert sorted(sizes) == list(range(kd.SHARDS))
    assert max(abs(s - share) for s in sizes.values()) < 0.05 * share
    assert len(texts[zlib.crc32(text.encode()), len(text) + 8]) > 1


def test_ranks_of_distinct_values_in_order(spark):
    values = [f"https://example.org/{random.Random(i).random()}" for i in range(500)] + ["", "ä", "z" * 300]
    frame = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "source string").repartition(7)
    assert {r.source: r["rank"] for r in kd.ranked(frame, "source").collect()} == {
        v: i for i, v in enumerate(sorted(set(values), key=lambda v: v.encode()))
    }


@pytest.mark.parametrize("shards", [2, 5, 8])
def test_shards_are_the_leaves_of_a_plain_tree(spark, shards):
    """Every split divides its part's lighter units at one place along its widest dimension."""
    rnd = random.Random(6)
    rows = []
    for i in range(4000):
        text = rnd.choice("abc") * rnd.choice([5, 40, 300, 900]) + str(i)
        rows.append((i * 7919 % 10_007, text, rnd.choice(["de", "en", None]), f"https://site.example/{rnd.randint(0, 40):03d}"))
    rows += [(20_000 + i, "g" * 3000, "en", "https://site.example/001") for i in range(5)]  # a whole group
    found = kd.assign(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), shards)
    shard_of = {r.doc_id: r.shard for r in found.collect()}
    assert {shard_of[20_000 + i] for i in range(5)} == {shard_of[20_000]}

    def dense(column):
        known = sorted({r[column] for r in rows if r[column] is not None})
        return lambda v: -1 if v is None else known.index(v)

    lang, source = dense(2), dense(3)
    total = sum(len(r[1]) + 8 for r in rows)
    units = [((log2(len(t) + 8), lang(g), source(s), d), len(t) + 8, shard_of[d]) for d, t, g, s in rows if d < 20_000]
    group = ((log2(3008), lang("en"), source("https://site.example/001"), 20_000), 5 * 3008, shard_of[20_000])
    extent = lambda part, k: max(u[0][k] for u in part) - min(u[0][k] for u in part)
    whole = [extent([*units, group], k) for k in range(4)]

    def check(part, first, n):
        if n == 1:
            return
        everything = part + ([group] if first <= group[2] < first + n else [])
        shares = [extent(everything, k) / whole[k] for k in range(4)]
        along = shares.index(max(shares))
        left = [u for u in part if u[2] < first + n // 2]
        right = [u for u in part if u[2] >= first + n // 2]
        assert left and right
        step = whole[along] / (1 << 19)  # keys have 20 bits of a value
        assert max(u[0][along] for u in left) <= min(u[0][along] for u in right) + step
        weight = sum(u[1] for u in everything if u[2] < first + n // 2)
        assert abs(weight - sum(u[1] for u in everything) * (n // 2) / n) <= 2 * 908 + total / shards / 100
        check(left, first, n // 2)
        check(right, first + n // 2, n - n // 2)

    check(units, 0, shards)
