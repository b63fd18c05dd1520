"""Each operator against a plain version, on texts with all the awkward cases."""

import hashlib
import html.entities
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import TESTDATA
from pyspark.sql import functions as F

from quittance.llm import (
    bpe_reuse,
    improbable_digest,
    kd_shards,
    phrase_automata,
    quality_cascade,
    simhash_ring,
    swap_packing,
    tokens,
    toxic_instances,
    url_cascade,
    warc_derivatives,
)
from quittance.llm.common import table

#: Other columns of the input, named as the operators' own.
CLASHING = "k1 k2 h1 a at id h fp root way part lot shard node size key listed bucket decided score words n_words".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choices("abcdeéßñ", k=rnd.randint(1, 7))) for _ in range(300)] + ["Don't", "1x2", "日本", "<|endoftext|>"]
    shared = [" ".join(rnd.choices(vocabulary, k=40)) for _ in range(4)]
    found = []
    for _ in range(70):
        parts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(3, 90))) for _ in range(rnd.randint(1, 4))]
        if rnd.random() < 0.5:
            parts.insert(1, rnd.choice(shared))
        found.append(rnd.choice([" ", "\n", " \t "]).join(parts))
    found += found[:6] + [t.replace(" ", "  ", 3) for t in found[6:9]]
    long = " ".join(rnd.choices(vocabulary, k=9000))
    return [*found, None, "", "", " \n\t", "word", long, long + " end", "x" * 20_000, "ab " * 4000]


ROWS = [(900 - 7 * i, t) for i, t in enumerate(texts())]
ROWS += ROWS[:2] + [(None, ROWS[3][1]), (None, None), (ROWS[5][0], "same id, another text " * 6)]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_ids_are_those_of_the_whole_text(docs, no_docs):
    tokenizer, expected = tokens.load(tokens.default_path()), Counter()
    for doc_id, text in ROWS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected[doc_id, tuple(ids), decoded] += 1
    found = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe_reuse.encode(docs).collect())
    assert found == expected
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows(bpe_reuse.digests(docs)) == Counter(
        {(d, len(i), sha(" ".join(map(str, i))), sha(t)): n for (d, i, t), n in expected.items()}
    )
    assert bpe_reuse.encode(no_docs).count() == 0


def test_a_cut_inside_a_word_is_repaired():
    text = b"one two threefour five six"
    encode = lambda t: tokens.encode(tokens.load(tokens.default_path()), t)
    for cut in range(1, len(text)):
        chunks = []
        for start, part in ((0, text[:cut]), (cut, text[cut:])):
            spans = [(start + m.start(), start + m.end()) for m in re.finditer(rb"\S+", part)]
            chunks.append(bpe_reuse.Chunk(spans, [encode(text[x:y]) for x, y in spans]))
        words = bpe_reuse.assemble(text, [cut, len(text)], chunks, encode)
        assert [i for w in words for i in w] == encode(text)


def test_a_full_memory_of_pieces_changes_nothing():
    small, data = tokens.Encoder(tokens.default_path(), 8), "a b c d e f g h i j k a don't éÀ 日本".encode()
    got = small.encode(np.frombuffer(data, np.uint8), np.array([0, 0, 5, len(data)]))
    assert got.ids.tolist() == tokens.encode(small.tokenizer, data)
    assert got.texts[:2].tolist() == [0, 0]


def simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if words else 0


def classes(items, linked):
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_near_duplicates_and_the_kept_ones(docs, no_docs):
    fps = [simhash(t) for _, t in ROWS]
    of = classes(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {c: min((d for (d, _), x in zip(ROWS, of, strict=True) if x == c and d is not None), default=None) for c in of}
    expected = Counter((d, f"{f:016x}", least[c]) for (d, _), f, c in zip(ROWS, fps, of, strict=True))
    found = simhash_ring.near_duplicates(docs).select("doc_id", simhash_ring.as_hex(F.col("fp")), "component_id")
    assert rows(found) == expected
    kept = simhash_ring.keep_first(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least[c] for c in set(of))
    assert simhash_ring.near_duplicates(no_docs).count() == simhash_ring.keep_first(no_docs).count() == 0


@pytest.mark.parametrize("run", [1, 4096])
def test_links_lose_no_connection(spark, run):
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for centre in list(fps)[:6]:
        for _ in range(25):
            centre ^= sum({1 << rnd.randrange(64) for _ in range(rnd.randint(1, 5))})
            fps.add(centre)
    fps = sorted(fps)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = simhash_ring.components(simhash_ring.links(frame, run=run))
    roots = {r.node: r.root for r in found.collect()}
    got = [roots.get(r.fp, r.fp) for r in frame.collect()]
    expected = classes(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    same = lambda x: [[a == b for b in x] for a in x]
    assert same(got) == same(expected)


def test_exploded_keys_are_not_broadcast(spark, monkeypatch):
    plans, store = [], simhash_ring.store

    def planned(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return store(frame)

    monkeypatch.setattr(simhash_ring, "store", planned)
    # the first 200 of 1,000 lie three to a place, one bit apart
    values = [(i // 3 << 40 | 1 << i % 3) if i < 200 else random.Random(i).getrandbits(63) for i in range(1000)]
    found = simhash_ring.links(spark.createDataFrame([(v,) for v in values], "fp long"))
    assert found.count()
    joined = [p for p in plans if "explode" in p and "Join" in p]
    assert joined and not any("BroadcastHashJoin" in p for p in joined)


def test_quality_counts_and_verdicts(docs, no_docs):
    expected = Counter()
    for doc_id, text in ROWS:
        words = WORD.findall(text or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        count = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        expected[doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed] += 1
    found = quality_cascade.judge(docs)
    assert rows(found.drop("kept")) == expected
    assert found.where("base_failed and kept").count() == 0
    passing = quality_cascade.keep(docs)
    assert passing.columns == docs.columns and passing.count() == found.where("kept").count()
    backwards = quality_cascade.verdict(F.col("text"), list((quality_cascade.BASE + quality_cascade.SIGNS)[::-1]))
    assert docs.where(backwards.isNull()).count() == passing.count()
    assert quality_cascade.judge(no_docs).count() == 0


def quality_kept(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    kinds = Counter(unicodedata.category(c) for c in text)
    letters = sum(n for kind, n in kinds.items() if kind[0] == "L")
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = sum(map(len, lines)) - sum(map(len, set(lines)))
    return (
        len(words) >= 10
        and 100 * len(repeated) <= 20 * len(words)
        and len(re.findall(r"[#*$%&|<>]", text)) <= 0.1 * len(words)
        and kinds["Lu"] <= 0.6 * letters
        and text.count("!") <= 0.5 * len(words)
        and again <= 0.3 * sum(map(len, lines))
        and 2 <= sum(map(len, words)) / len(words) <= 20
    )


def test_kept_texts_are_those_of_a_plain_version(spark, docs):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9)))
    prose = [word() for _ in range(40)]
    made = [" | ".join(prose), " ".join(prose), " ".join([*prose[:-4], *"#*|<"]), " ".join([*prose[:-5], *"#*|<&"])]
    made += [" ".join(prose).upper(), "! ".join(prose), "! ".join(prose[:21]) + " " + " ".join(prose[21:])]
    made += [" ".join(w * 9 for w in prose), " ".join("a1b2c3d4e5"[i % 10] for i in range(13)), " ".join(map(chr, range(0xC0, 0xD6)))]
    made += ["\n".join([" ".join(prose[:9]), " ".join(prose[9:30]), " ".join(prose[:9])]), "Éa ÀB ßc " * 5 + " ".join(prose)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_cascade.judge(frame).collect()}
    assert kept == {i: quality_kept(t) for i, t in enumerate(made)}
    assert not kept[0] and kept[1] and kept[2] and not kept[3]
    for texts in (docs, table(spark, TESTDATA, "documents")):
        expected = Counter((r.doc_id, quality_kept(r.text)) for r in texts.select("doc_id", "text").collect())
        assert rows(quality_cascade.judge(texts).select("doc_id", "kept")) == expected


def test_repeated_lines_count_by_length(spark):
    body = " ".join(f"word{i}" for i in range(40))
    texts = [(1, f"A heading\n{body}\nA heading"), (2, f"{body}\nA line between\n{body}"), (3, None), (4, "")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rules = [r for r in quality_cascade.SIGNS if r.name == "duplicate_lines"]
    assert [r.doc_id for r in frame.where(quality_cascade.verdict(F.col("text"), rules).isNotNull()).collect()] == [2]


@pytest.mark.parametrize("hot", [1, 5000])
def test_repeated_windows_go(docs, no_docs, monkeypatch, hot):
    monkeypatch.setattr(phrase_automata, "HOT", hot)
    as_id = lambda d: phrase_automata.NO_ID if d is None else d
    owners, expected = {}, Counter()
    for doc_id, text in ROWS:
        words = WORD.findall(text or "")
        for k in range(len(words) - 12):
            window = tuple(words[k : k + 13])
            owners[window] = min(owners.get(window, phrase_automata.NO_ID), as_id(doc_id))
    for doc_id, text in ROWS:
        words = WORD.findall(text or "")
        gone = {k + j for k in range(len(words) - 12) if owners[tuple(words[k : k + 13])] < as_id(doc_id) for j in range(13)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        expected[doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert rows(phrase_automata.digests(docs)) == expected
    left = phrase_automata.remove_repeats(docs)
    assert left.columns == docs.columns
    own = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
    assert Counter((r.doc_id, own(r.text)) for r in left.collect()) == sum(
        (Counter({(d, s): n}) for (d, _, _, s), n in expected.items()), Counter()
    )
    assert phrase_automata.digests(no_docs).count() == 0


def test_owners_of_windows_are_not_broadcast(docs, monkeypatch):
    plans, store = [], phrase_automata.store

    def planned(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return store(frame)

    monkeypatch.setattr(phrase_automata, "store", planned)
    phrase_automata.Found(docs)
    joined = [p for p in plans if "collect_list" in p and "Join" in p]
    assert joined and not any("BroadcastHashJoin" in p for p in joined)


def test_pieces_fill_sequences(docs, no_docs):
    tokenizer, expected = tokens.load(tokens.default_path()), Counter()
    for doc_id, text in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    packed = swap_packing.pack(docs).collect()
    assert Counter(tuple(r)[:5] for r in packed) == expected
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 4096
    assert len(sequences) == -(-sum(r.length for r in packed) // 4096)
    assert swap_packing.pack(no_docs).count() == 0


def test_swaps_empty_a_bin_that_best_fit_leaves():
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])  # best fit: 6+4, 5+5, 4+3+3
    for bins in (swap_packing.pack_lengths(lengths, 10), swap_packing._Search(lengths, [[0, 5], [1, 3], [2, 4], [6]], 10).run()):
        assert len(bins) == 3 and sorted(i for b in bins for i in b) == list(range(7))
        assert all(lengths[b].sum() <= 10 for b in bins)


def test_digests_follow_the_edit(docs, no_docs):
    h = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()}
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), -h[r[1]]))
    expected = Counter()
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        expected[doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()] += 1
    found = improbable_digest.compare_neighbours(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    long = [r for r in found if r.n_chars > 500 and r.doc_id != ROWS[-6][0]]
    assert np.median([r.near_edited for r in long]) > 0.5 > np.median([r.near_next for r in long]) + 0.3
    assert improbable_digest.compare_neighbours(no_docs).count() == 0
    marks = defaultdict(set)
    for r in improbable_digest.fingerprints(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        marks[r.doc_id].add(r.fingerprint)
    assert marks[ROWS[0][0]] == marks[ROWS[70][0]]  # an exact copy


def test_every_window_is_ranked_and_may_be_voted_for():
    rnd = random.Random(9)
    texts = ["".join(rnd.choices("abcdé fg", k=n)).encode() for n in (0, 5, 63, 64, 70, 90, 150, 300, 700, 1500)] + [b"x" * 400]
    rarity, expected = np.random.default_rng(9).permutation(256), []
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    for text, start in zip(texts, offsets.tolist(), strict=False):
        classes = []
        for i in range(len(text) - 63):
            counts = Counter(text[i : i + 64]).values()
            classes.append(round((6 - sum(n * math.log2(n) for n in counts) / 64) / 6 * 255))
        assert improbable_digest.entropy_classes(np.frombuffer(text, np.uint8)).tolist() == classes
        voters = next((v for v in (1, 2, 4, 8, 16, 32) if len(classes) < 16 * v), 64)
        votes = Counter()
        for i in range(1 - voters, len(classes)):
            votes[min(range(max(0, i), min(i + voters, len(classes))), key=lambda j: (rarity[classes[j]], j))] += 1
        expected += [start + j for j in sorted(votes) if votes[j] >= max(1, voters // 4)]
    ranks = rarity.astype(np.uint8)[improbable_digest.entropy_classes(data)]
    assert improbable_digest.select(ranks, improbable_digest.across(offsets, len(ranks)), offsets).tolist() == expected


def test_short_texts_are_alike_after_an_edit(spark):
    rnd = random.Random(10)
    texts = ["".join(rnd.choices("abcdefghijklmn opq", k=n)) for n in [*range(3, 300, 3), *range(300, 400, 10)] for _ in range(2)]
    texts += ["".join(rnd.choices("日本語é", k=n)) for n in range(3, 130)]
    found = improbable_digest.compare_neighbours(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    assert [r.n_chars for r in found if r.near_edited == 0] == []
    assert np.median([r.near_edited for r in found]) > 0.3 > np.median([r.near_next for r in found]) + 0.2


def test_shards_are_even_and_slots_gapless(docs, no_docs):
    placed = kd_shards.assign(docs, 5).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in ROWS
    )
    slots, sizes = defaultdict(list), Counter()
    for r in placed:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert sorted(slots) == list(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in placed)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert kd_shards.assign(no_docs).count() == 0


def test_toxic_sentences_are_found(spark, no_docs):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefg", k=4)) for _ in range(200)]
    made = []
    for i in range(400):
        parts = [" ".join(rnd.choices(words, k=12)) for _ in range(6)]
        if i % 4 == 0:
            parts[2] = f"you {rnd.choice(['vile', 'rotten'])} thing"
        made.append((i, ". ".join(parts), int(i % 4 == 0)))
    made += [(None, "a rotten thing", 1), (1000, None, 0), (1001, "", 0), (1002, "x " * 50_000, 0)]
    frame = spark.createDataFrame(made, "doc_id long, text string, score int")
    labels = frame.select("doc_id", F.col("score").alias("toxic")).unionByName(
        spark.createDataFrame([(5, None), (None, 1)], "doc_id long, toxic int")
    )
    model = toxic_instances.fit(frame, labels)
    scored = {r.doc_id: r for r in toxic_instances.score(frame, model).collect()}
    held = [i for i, _, _ in made[:400] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((scored[i].score >= 0.7) == (i % 4 == 0) for i in held)
    worst = max(scored[0].sentences, key=lambda s: s.score)
    assert made[0][1][worst.start : worst.end].strip().startswith("you ")
    assert scored[1000].score == scored[1001].score == 0
    clean = toxic_instances.keep_clean(frame, model)
    assert clean.columns == frame.columns and clean.where("doc_id % 4 = 0 and doc_id < 400").count() == 0
    assert toxic_instances.judged(no_docs, labels.where("false")).count() == 0


def test_cascade_is_exact_and_rules_win(spark):
    urls = [f"HTTP://A{i}.Example.{t}/{p}/{i}?q" for i in range(300) for t in ("net", "org", "com") for p in ("en", "de")]
    urls += ["https://org/x", "http://notorg/", "no scheme", "", None, urls[0], "http://h#f", "http://example.org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit("x"))
    keys = {f"a{i}.example.net/en/{i}" for i in range(0, 300, 7)} | {"elsewhere/1"}
    listed = spark.createDataFrame([(k,) for k in keys], "key string")
    found = url_cascade.judge(pages, listed).collect()
    assert [r.page_id for r in sorted(found, key=lambda r: r.page_id)] == list(range(len(urls)))
    for r in found:
        if r.rule is None:
            assert (r.verdict == "block") == (r.host + r.path in keys)
    by_page = {r.page_id: r for r in found}
    at = len(urls) - 8
    assert (by_page[at].rule, by_page[at].verdict, by_page[at + 1].rule) == ("org/", "allow", None)
    assert [(by_page[at + k].host, by_page[at + k].path) for k in (2, 3, 4)] == [("", "")] * 3
    assert by_page[2 + 6].rule == "example.org/en/1" or by_page[8].host == "a1.example.org"
    assert url_cascade.judge(pages.where("false"), listed).count() == 0
    assert url_cascade.judge(pages, listed.where("false")).where("rule is null and verdict = 'block'").count() == 0


@pytest.mark.parametrize("at_once", [8, 2])
def test_shards_of_a_list_agree_with_one(spark, monkeypatch, at_once):
    monkeypatch.setattr(url_cascade, "CASCADES_AT_ONCE", at_once)
    keys = spark.createDataFrame([(f"k{i}", i % 3 == 0) for i in range(2000)], "key string, listed boolean")
    monkeypatch.setattr(url_cascade, "SHARD", 100)
    cascades = url_cascade.build(url_cascade.hashed(keys).cache())
    assert len(cascades) == 7
    marked = url_cascade.mark(keys.drop("listed"), cascades)
    assert marked.exceptAll(keys).count() == 0 and marked.count() == 2000


def test_records_point_to_their_response(spark, tmp_path):
    html = "<html><title>A &amp; B</title><script>x<p></script><p>One<br>two &lt;3</p><a href='/x'>y</a></html>"
    pages = spark.createDataFrame([(1, "http://a/", html), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    source = warc_derivatives.responses(pages.withColumn("block", F.lit(1)))
    made = warc_derivatives.derive(source).collect()
    assert len(made) == 6
    ids = {r.page_id: r.record_id for r in source.collect()}
    for r in made:
        assert r.refers_to == ids[r.page_id] and f"WARC-Refers-To: {r.refers_to}\r\n" in r.headers
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert f"Content-Length: {len(r.block.encode())}\r\n\r\n" in r.headers
    text = next(r.block for r in made if r.page_id == 1 and r.record_type == "conversion")
    assert text == "A & B\nOne\ntwo <3\ny"
    warc_derivatives.write(warc_derivatives.derive(source), str(tmp_path / "out"), "none")
    written = "".join(p.read_bytes().decode() for p in (tmp_path / "out").glob("part-*"))
    assert written.count("WARC/1.1\r\n") == 6 and written.endswith("\r\n\r\n")


def test_all_character_references_are_decoded(spark):
    names = sorted(html.entities.html5)  # some without a semicolon
    parts = [f"a&{n} b" for n in names if html.unescape(f"&{n}").strip()] + [f"&#{n};" for n in (33, 128, 169, 8364, 128512, 0, 1, 55296, 1 << 30)]
    parts += ["&#xA9;", "&#Xe9", "&copy2", "&notit;", "&amp;lt;", "&amp;amp;copy;", "&unknown;", "AT&T", "& ", "&;", "&#;", "&nbsp;x&#160;y"]
    pages = [(i, "http://a/", f"<title>{p}|{p}</title><p>x{p}x</p>") for i, p in enumerate(parts)] + [(len(parts), None, None)]
    pages.append((-1, "u", "<title>A&#13;&#10;B: c</title>"))
    source = warc_derivatives.responses(spark.createDataFrame(pages, "page_id long, url string, html string"))
    made = {(r.page_id, r.record_type): r.block for r in warc_derivatives.derive(source).collect()}
    title = lambda i: re.search("title: ([^\r]*)\r\n", made[i, "metadata"])[1]
    space = lambda t: re.sub(" ?\n[ \n]*", "\n", re.sub("[ \t\r\f]+", " ", t)).strip(" \n")
    for i, part in enumerate(parts):
        plain = [html.unescape(t).replace("\xa0", " ") for t in (f"{part}|{part}", f"x{part}x")]
        assert made[i, "conversion"] == space("\n".join(plain)), part
        assert title(i) == re.sub("[\r\n]+", " ", plain[0]), part
        assert f"text-length: {len(made[i, 'conversion'].encode())}\r\n" in made[i, "metadata"]
    assert made[len(parts), "conversion"] == "" and title(-1) == "A B: c"


def test_pipeline_stages_chain(spark):
    import corpus_pipeline as pipeline

    docs = table(spark, TESTDATA, "documents")
    columns = docs.columns
    toxic = table(spark, TESTDATA, "labels").where("toxic = 1")
    kept = docs
    for name, stage in pipeline.STAGES[:-1]:
        after = pipeline.store(stage(spark, kept, TESTDATA))
        assert after.columns == columns, name
        assert after.join(kept, "doc_id", "left_anti").count() == 0
        kept = after
    assert kept.join(toxic, "doc_id").count() < toxic.count()
    assert simhash_ring.near_duplicates(docs.join(kept, "doc_id", "left_semi")).where("doc_id != component_id").count() == 0
    packed = pipeline.run(spark, TESTDATA)
    assert packed.select("doc_id").distinct().count() == kept.count()
