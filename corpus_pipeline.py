"""Preparing a corpus for training: language, quality, near duplicates, packing.

Each stage works on all documents that the one before it kept.  Every stage's result is written as Parquet
and read back, so a lost executor repeats a part of one stage only.

* ``language_id`` learns language filters from the documents themselves and drops those whose language no
  filter knows: texts without a letter, or with less than three tenths of their n-grams in any one language.
* ``quality`` fits the ordinal model on the table ``labels`` and drops documents that are probably not sound.
* ``near_duplicates`` joins word-shingle sets (five words, similarity 0.8) and keeps the document with the
  smallest id of each class.
* ``packing`` returns the token sequences of what is left, as ``bin_packing.packed`` does.

Rows that are null in ``text`` are dropped by the first stage; extra columns of ``documents`` are carried on
to the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import bin_packing, jaccard_regions, language_filters, ordinal_quality
from ordermill.llm.tables import read, written

#: Least share of a text's n-grams in its language.
KNOWN = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_filters.accepted(docs, language_filters.learn(docs.select("lang", "text")), KNOWN)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal_quality.kept(docs, ordinal_quality.learn(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_regions.one_of_each(docs, words=5, per_cent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bin_packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: Learned models and packing are not expressed in SQL; every stage and the rows of ``run`` are tested against
#: brute force in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
