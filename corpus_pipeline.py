"""From raw documents to token shards: toxicity, near copies, benchmark leaks, mixing, token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. Stages before the last
return the columns of ``documents``; what a stage removes is gone for those after it.

Cases, for every stage: null columns and texts count as empty; rows without doc_id, or that share
one, are rows of their own, told apart by a row number; a text of any length is worked on whole; repeated
rows are near copies of each other, so one stays; an empty table goes through as one; other columns
are kept up to the last stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, mixing, simhash, sstable, toxicity
from quire.llm.common import drop_folder, materialize, recording, table
from quire.llm.queries import tokenizer_path


_left: dict[str, list[str]] = {}


def stage(function):
    """A stage's docs are its predecessor's rows, written and read again; so what the predecessor wrote for
    itself on the way is dropped before a stage begins."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_left(spark, sf_dir)
        with recording() as made:
            out = function(spark, docs, sf_dir)
        _left[sf_dir] = made
        return out

    return run_stage


def drop_left(spark: SparkSession, sf_dir: str) -> None:
    for folder in _left.pop(sf_dir, ()):
        drop_folder(spark, folder)


@stage
def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score 0.5 or more go."""
    model = toxicity.train(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.remove_toxic(docs, model)


@stage
def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each SimHash component stays, the smallest doc_id (null last; of rows
    that share it the first written)."""
    return simhash.keep_representatives(docs)


@stage
def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that share a longest match of 13 words or more (or a whole shorter item) with a
    benchmark item go, however long they are."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as often as the mix of sources takes it."""
    return mixing.repeat_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token-id shards, and for each document what they hold. Its shards and manifest stay."""
    drop_left(spark, sf_dir)
    return sstable.read_shards(sstable.write_shards(docs, tokenizer_path()))


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash near-dedup", remove_near_copies),
    ("benchmark decontamination", remove_leaks),
    ("mixing sources", mix_sources),
    ("token shards", write_tokens),
]

#: A trained classifier and a balanced sample are not SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
