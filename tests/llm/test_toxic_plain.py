"""Toxicity scores against a plain noisy-or of plainly scored sentences."""

import math
import re

from pyspark.sql import functions as F

from quittance.llm import toxic_instances as ti

WEIGHTS = {"vile": 3.0, "vile-": 1.0, "rott-": 2.5, "rotte-": 2.0, "bad": 0.5, "straß-": 1.5}
TEXTS = [
    None, "", " \n", "all is well.", "A VILE thing. Then nothing! bad? rotten, rotted", "bad bad bad.bad\nbad", "İvile rott rottenest",
    "Straße. strassen straßen", "vile" * 10_000, "x. " * 30_000 + "vile", "no stop at the end bad",
]


def plain(text):
    total, found = 1.0, []
    for match in re.finditer(r"[^.!?\n]+", text):
        words = set(re.findall(r"\w+", "".join(c.lower() if len(c.lower()) == 1 else c for c in match[0])))
        known = words | {f"{w[:4]}-" for w in words if len(w) > 4} | {f"{w[:5]}-" for w in words if len(w) > 5}
        own = [w for w in WEIGHTS if w in known]
        if own:
            score = 1 / (1 + math.exp(4.0 - sum(WEIGHTS[w] for w in own)))
            found.append((match.start(), match.end(), round(score, 9)))
            total *= 1 - score
    return round(1 - total, 9), found


def test_scores_and_places_of_all_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[4]), (3, TEXTS[4]), (None, TEXTS[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("x").alias("score"), F.lit(1).alias("sentences"))
    found = ti.score(docs, ti.Model(WEIGHTS, ti.BIAS)).collect()
    mine = [(r.doc_id, round(r.score, 9), [(s.start, s.end, round(s.score, 9)) for s in r.sentences]) for r in found]
    assert sorted(mine, key=repr) == sorted(((d, *plain(t or "")) for d, t in rows), key=repr)
    kept = ti.keep_clean(docs, ti.Model(WEIGHTS, ti.BIAS))
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(d or -1 for d, t in rows if plain(t or "")[0] < ti.THRESHOLD)
    assert ti.score(docs.where("false"), ti.Model({}, ti.BIAS)).count() == 0
