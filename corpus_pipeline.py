"""A corpus pipeline: five stages, each one operator of `revisit.llm` over all that the stage before kept.

Each stage is written as Parquet and read again as the next one's documents. All but the last return the
columns of documents. A stage removes the scratch tables of the stages before it, unless its documents still
read them: what a stage has written is all that the next one needs.

Documents with null or blank texts fail the base rules and go first. A null language is one without word lists of
its own; null sources are a source of their own. Of near copies, repeated rows among them, the row with the least id
stays, one without an id before any other, by place among equal ids. Long texts are taken whole in every stage. Extra
columns stay as they are up to the packing, whatever their names. An empty table stays empty through all stages.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revisit.llm import dartminhash, divergence, mixing, packing, suffix_dedup
from revisit.llm.common import materialise, recorded, release, table
from revisit.llm.tokens import Room

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Workers stay from stage to stage, beside an executor's heap, so their encoders are kept small.
ROOM = Room(most=100_000, together=1 << 20)
#: Scratch tables of the stages of this run so far.
_scratch: list[str] = []


def stage(run: Stage) -> Stage:
    @functools.wraps(run)
    def stepped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if run.__name__ == "quality_rules":
            _scratch.clear()  # a new run; what an earlier one left may still be read
        release(_scratch, docs)
        with recorded(_scratch):
            return run(spark, docs, sf_dir)

    return stepped


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go."""
    return divergence.quality_filter(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return dartminhash.near_dedup(docs)


@stage
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier are taken out; documents of which no word is left go."""
    return suffix_dedup.remove_repeats(docs).filter(r"text rlike '[^\\x20\\x09-\\x0D]'")


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source cut to its target."""
    return mixing.mix_documents(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences."""
    import public_tokenizers

    return packing.pack_report(docs, public_tokenizers.path("word_bpe_49k.json"), room=ROOM)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mix", source_mix),
    ("pack", pack),
]
#: Tokenizing and signatures are not SQL's; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        with recorded(_scratch):
            docs = materialise(step(spark, docs, sf_dir), name)
    return docs
