"""Each stage of the pipeline, row by row, against plain Python over what the stage before kept."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import TESTDATA
from test_operators import WORD, classes, quality_kept, simhash

import corpus_pipeline as pipeline
from quittance.llm import phrase_automata, tokens, toxic_instances
from quittance.llm.common import table


def toxic_score(text, weights):
    total = 1.0
    for sentence in re.findall(r"[^.!?\n]+", "".join(c.lower() if len(c.lower()) == 1 else c for c in text or "")):
        words = set(re.findall(r"\w+", sentence))
        known = words | {f"{w[:n]}-" for w in words for n in (4, 5) if len(w) > n}
        own = sorted(known & weights.keys())
        if own:
            total *= 1 - 1 / (1 + math.exp(-toxic_instances.BIAS - sum(weights[w] for w in own)))
    return 1 - total


def plain_toxicity(rows, weights):
    return [r for r in rows if toxic_score(r[1], weights) < 0.7]


def plain_quality(rows):
    return [r for r in rows if quality_kept(r[1])]


def plain_near_duplicates(rows):
    fps = [simhash(t) for _, t in rows]
    found = defaultdict(list)
    for row, c in zip(rows, classes(fps, lambda a, b: (a ^ b).bit_count() <= 4), strict=True):
        found[c].append(row)
    return [min(group) for group in found.values()]


def plain_repeats(rows):
    """``doc_id`` and the words left."""
    owners = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - 12):
            window = tuple(words[k : k + 13])
            owners[window] = min(owners.get(window, phrase_automata.NO_ID), doc_id)
    found = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = {k + j for k in range(len(words) - 12) if owners[tuple(words[k : k + 13])] < doc_id for j in range(13)}
        found.append((doc_id, [w for k, w in enumerate(words) if k not in gone]))
    return found


def plain_pieces(rows):
    tokenizer, found = tokens.load(tokens.default_path()), Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            found[doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return found


def test_every_stage_equals_its_plain_version(spark):
    docs = table(spark, TESTDATA, "documents")
    weights = toxic_instances.fit(docs, table(spark, TESTDATA, "labels")).weights
    assert weights
    plain = {
        "toxicity": lambda rows: plain_toxicity(rows, weights),
        "quality": plain_quality,
        "near_duplicates": plain_near_duplicates,
    }
    listed = lambda frame: sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "repeated_passages", "packing"]
    for name, stage in pipeline.STAGES:
        before, made = listed(docs), pipeline.store(stage(spark, docs, TESTDATA))
        if name in plain:
            after = listed(made)
            assert after == sorted(plain[name](before)) and len(after) < len(before), name
        elif name == "repeated_passages":
            words = [(d, WORD.findall(t or "")) for d, t in listed(made)]
            expected = sorted(plain_repeats(before))
            assert words == expected and sum(len(w) for _, w in words) < sum(len(WORD.findall(t or "")) for _, t in before)
            lengths = {r.doc_id: (r.n_chars, len(r.text or "")) for r in made.collect()}
            assert all(n == length for n, length in lengths.values())
        else:
            packed = made.collect()
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == plain_pieces(before)
            held = defaultdict(list)
            for r in packed:
                held[r.sequence_id].append((r.offset, r.length))
            for places in held.values():
                places.sort()
                assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
                assert sum(n for _, n in places) <= 4096
        docs = made
