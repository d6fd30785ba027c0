"""A training corpus, stage by stage: quality, near-duplicates, benchmark leaks, secrets, packing.

Each stage takes the documents that the one before has kept, and returns them with the columns of ``documents``; the
last returns pieces. A stage's result must be written before the next stage is called in the same thread, as ``run``
does: the next one then deletes what its predecessor had staged. It touches nothing else: not what other threads, other
stages or other queries have staged. What the last stage staged goes with ``common.sweep``, with ``run``, or when the process ends.

Every stage reads whole texts, a very long one by itself; takes a null text as an empty one; lets repeated rows and
null ids each stand for themselves (but for ``near_dedup``); passes on columns that it doesn't know, whatever their
names; and returns no rows for no rows.
"""

from __future__ import annotations

import uuid
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from playlog.llm.common import Scope, scope, shared_dir, table
from playlog.llm.decontaminate import decontaminated
from playlog.llm.neardup import deduplicated
from playlog.llm.packing import pack
from playlog.llm.quality import accepted
from playlog.llm.queries import tokenizer_path
from playlog.llm.secrets import redacted, trained


#: What the last stage called in this thread has staged, by its name.
_before: ContextVar[tuple[str, Scope] | None] = ContextVar("before", default=None)


def _in_turn(step):
    """The stage; what its predecessor staged in this thread goes first, since its result has been written by then."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [name for name, _ in STAGES]
        at, before = names.index(step.__name__), _before.get()
        if before and at and before[0] == names[at - 1]:
            before[1].sweep(spark)
        with scope() as own:
            out = step(spark, docs, sf_dir)
        _before.set((step.__name__, own))
        return out

    return run_step


@_in_turn
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts; equal texts are accepted or dropped together, empty ones as one empty line."""
    return accepted(docs, table(spark, sf_dir, "labels"))


@_in_turn
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share four fifths of their five-word shingles or more.

    SimHash fingerprints, searched by vantage-point trees, propose links, whole shingle sets decide, and MinHash keys
    find what lies beyond the trees' radius. The smallest doc_id stays, a null one only if there is no other; of
    repeated rows any one; all null, empty and blank texts are one component.
    """
    return deduplicated(docs)


@_in_turn
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage near a benchmark item; null and empty items are near nothing."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


@_in_turn
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; overlapping spans are one, a null text stays null."""
    return redacted(docs, trained(docs))


@_in_turn
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences along the curve; an empty document is its end token, documents of equal keys go by row."""
    return pack(docs, tokenizer_path(), with_ids=False)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("packing", packing)]

#: Trained models and iterative searches aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again; only the last one's rows stay in the shared folder."""
    docs, name, before = table(spark, sf_dir, "documents"), uuid.uuid4().hex, None
    conf, Path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    held = _before.set(None)
    try:
        for stage, step in STAGES:
            path = f"{shared_dir(spark)}/pipeline-{name}-{stage}"
            step(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                Path(before).getFileSystem(conf).delete(Path(before), True)
            before = path
        _before.get()[1].sweep(spark)
    finally:
        _before.reset(held)
    return docs
