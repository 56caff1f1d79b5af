"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of its predecessor and calls one
operator of :mod:`hitroll.llm`. All but the last return the columns of documents:

1. quality rules: documents that fail the base rules or a fence of their language and source go;
2. line dedup: lines found in many documents go (the documents stay);
3. n-gram Jaccard join: one document stays of each group linked by 5-word shingles at 0.8;
4. mixing: documents repeat by source until no source is read more often than twice as much as
   the least repeated one, which is read exactly once;
5. best-fit packing: token pieces with their sequence and offset.
"""

from __future__ import annotations

from hitroll.llm import line_dedup, mixing, ngram_join, packing, quality
from hitroll.llm.common import cut


def quality_rules(spark, docs, sf_dir):
    return quality.filter_quality(docs)


def common_lines(spark, docs, sf_dir):
    return line_dedup.without_common_lines(docs)


def near_duplicates(spark, docs, sf_dir):
    return ngram_join.one_of_each(docs, k=5, percent=80)


def source_mix(spark, docs, sf_dir):
    return mixing.mixed_documents(docs)


def packed(spark, docs, sf_dir):
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", common_lines),
    ("ngram_jaccard", near_duplicates),
    ("source_mixing", source_mix),
    ("best_fit_packing", packed),
]

# Tokenization and packing have no SQL form: tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
