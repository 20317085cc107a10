"""A training corpus from raw documents, stage by stage; each stage is one operator of ``basketlens.llm``."""

from __future__ import annotations

from basketlens.llm import exact_dedup, packing, quality, shingle_join, substring_dedup
from basketlens.llm.common import table
from basketlens.session import clear_scratch, made, materialize


def good_documents(spark, docs, sf_dir):
    """Documents that the quality network, fitted on ``labels``, doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark, docs, sf_dir):
    """One row per distinct text: the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark, docs, sf_dir):
    """Of each group of documents connected by similar shingle sets (five words, 0.8), the smallest doc_id."""
    return shingle_join.one_of_each(docs, percent=80, width=5)


def without_repeats(spark, docs, sf_dir):
    """Documents without the words of repeated windows; a document that loses none keeps its text as it is."""
    return substring_dedup.drop_repeats(docs)


def packed(spark, docs, sf_dir):
    """Pieces of documents with their words, and the sequences they go to."""
    return packing.pack(docs, words=True)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("substring dedup", without_repeats),
    ("best-fit packing", packed),
]

#: A learned network decides the first stage, which SQL can't express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages one after the other, each written to the shared folder and read again; only the last one's tables stay.

    Rows are decided by id and text: repeated rows, null ids and ids with several texts lose what their text loses. Null
    and empty texts pass the stages like any other text of their score and make pieces without words. An empty table
    gives no rows; without labels the first stage keeps all. Texts of any length are worked on whole.
    """
    docs = table(spark, sf_dir, "documents")
    since = made()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        clear_scratch(spark, since, keep=1)  # what the stage has read and made, but its result
    return STAGES[-1][1](spark, docs, sf_dir)
