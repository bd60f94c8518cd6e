"""A training-data pipeline over ``documents``: five stages, each on all that the last one kept.

quality -> line dedup -> near-duplicates -> mixing -> packing. Every stage but the last takes and
returns rows with the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import best_fit, cube_mix, line_suffix, sketch_join, subword_classifier
from terrace.llm.common import materialize, python_workers
from terrace.llm.queries import table, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier scores 0.3 or more. It is trained on
    labelled documents of the input outside the held-out fifth."""
    python_workers(spark, rows=1000)
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"), label="quality")
    return docs.where(subword_classifier.score_column(model, F.col("text")) >= 0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of line runs of 50 words or more. A document that loses all its
    words goes; ``n_chars``, where there is one, follows the text."""
    cleaned = line_suffix.delete_repeats(docs, min_words=50)
    gone = cleaned.columns[-1]
    left = cleaned.where((F.col(gone) == 0) | F.coalesce(F.col("text").rlike(line_suffix.WORD), F.lit(False)))
    changed = F.col(gone) > 0
    return left.select(*[F.when(changed, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                         if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest doc_id, of each group of near-duplicates: linked by a
    Jaccard similarity of 0.8 or more on shingles of five words."""
    return sketch_join.keep_one(docs, sketch_join.near_duplicates(docs, length=5, least=80, out_of=100))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source to its target size; documents may be left out or taken twice."""
    return cube_mix.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all tokens into sequences of 1024; a repeat is packed as a document of its own."""
    return best_fit.pack_documents(docs, vocabulary(), capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", near_dedup),
    ("mixing sources", mixing), ("best-fit packing", packing)]

#: Subword scores, cube sampling and token ids have no SQL. tests/llm hold line dedup, near-duplicates and packing
#: against brute force, quality against held-out labels, and mixing against its targets and its own reruns.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
