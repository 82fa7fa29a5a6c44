"""A training corpus in five stages, from ``documents`` to packed token sequences.

Every stage works on all that its predecessor kept.  ``run`` writes each stage's rows to the
shared folder and reads them again, so a lost executor repeats tasks of one stage only.

In every stage a null text is empty, null ids, languages and sources are values like others, long
texts are read whole, columns may have any name, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from counterfold.llm.common import documents, stored
from counterfold.llm.jaccard import keep_first
from counterfold.llm.mixing import mix_sources, repeat_rows
from counterfold.llm.packing import pack_documents
from counterfold.llm.rules import keep_good, language_references
from counterfold.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on what is left of the labels, does not reject.

    Empty texts stay; repeated rows are judged row by row; without labels of both kinds all stay."""
    return drop_toxic(docs, fit_toxicity(docs, documents(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like a language of the corpus.

    Empty texts fail; repeated rows are judged row by row; languages too small to have a
    reference are judged by the base rules alone."""
    return keep_good(docs, language_references(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with Jaccard 0.8 or more on shingles of five words.

    The least id stays, of rows with that id the least text; repeated rows are one; texts without
    shingles stay, one for each id."""
    return keep_first(docs, size=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once, or up to three times.

    Empty texts are taken as often as their source asks; rows equal in id, source and text are
    taken together."""
    return repeat_rows(docs, mix_sources(docs, keyed=True))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, in sequences of at most 1,024.

    An empty text is its end id alone; repeated rows are packed row by row."""
    # the workers of the stages before wait beside those at work and each gets tasks in turn
    return pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end=0, remembered=200_000)


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: Fitted models and the walk of the cube method are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    for place, (_, stage) in enumerate(STAGES):
        rows = stored(stage(spark, rows, sf_dir), f"stage-{place}")
    return rows
