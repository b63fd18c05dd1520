"""The operators of this subpackage as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quittance.llm import (
    audit_repair,
    bpe_reuse,
    improbable_digest,
    kd_shards,
    phrase_automata,
    prefix_trie,
    quality_cascade,
    simhash_ring,
    swap_packing,
    toxic_instances,
    url_cascade,
    warc_derivatives,
    word_shuffle,
)
from quittance.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    found = simhash_ring.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", simhash_ring.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def url_verdicts(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return url_cascade.judge(pages, url_cascade.rejected_documents(pages, table(spark, d, "labels")))


def _importable(query: Query) -> Query:
    """Python workers started from any folder find this package where the driver found it.

    A cluster installs the package or gets it by --py-files; this is for a shared folder.
    """

    def run(spark: SparkSession, d: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(corpus_pipeline.__file__).resolve().parent))
        return query(spark, d)

    return run


_QUERIES: dict[str, Query] = {
    "op1_bpe_reuse": lambda spark, d: bpe_reuse.digests(table(spark, d, "documents")),
    "op2_url_cascade": url_verdicts,
    "op3_simhash_ring": near_duplicates,
    "op4_quality_cascade": lambda spark, d: quality_cascade.judge(table(spark, d, "documents")),
    "op5_phrase_automata": lambda spark, d: phrase_automata.digests(table(spark, d, "documents")),
    "op6_warc_derivatives": lambda spark, d: warc_derivatives.derive(warc_derivatives.responses(table(spark, d, "pages"))),
    "op7_improbable_digest": lambda spark, d: improbable_digest.compare_neighbours(table(spark, d, "documents")),
    "op8_toxic_instances": lambda spark, d: toxic_instances.judged(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_swap_packing": lambda spark, d: swap_packing.pack(table(spark, d, "documents")),
    "op10_kd_shards": lambda spark, d: kd_shards.assign(table(spark, d, "documents")),
    "op11_word_shuffle": lambda spark, d: word_shuffle.digests(table(spark, d, "documents")),
    "op12_audit_repair": lambda spark, d: audit_repair.damage_and_repair(table(spark, d, "conversations")),
    "op13_prefix_trie": lambda spark, d: prefix_trie.shared_beginnings(table(spark, d, "conversations")),
    "pipeline": corpus_pipeline.run,
}

QUERIES = {name: _importable(query) for name, query in _QUERIES.items()}

ORACLE: dict[str, str] = {
    "op2_url_cascade": url_cascade.ORACLE,
    "op6_warc_derivatives": warc_derivatives.ORACLE,
    "op12_audit_repair": audit_repair.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
