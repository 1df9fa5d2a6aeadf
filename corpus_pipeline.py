"""From raw documents to packed training sequences, one stage after the other.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; all but the last return the
columns of documents. ``run`` writes each stage's result as Parquet into the shared folder and reads it for the next,
so a lost executor costs a part of one stage.

quality_rules      documents that a rule rejects go
line_dedup         lines on over a tenth of their source's documents go; the documents stay
near_duplicates    of each component of fingerprints (three-word shingles) linked at three differing bits or fewer, the
                   document with the smallest id stays (of equal ids the first row; rows without an id only where no row
                   of the component has one)
decontaminate      documents that overlap a benchmark item go
packing            one row per piece, with its ids and its place in a window of 2048

A null text has no words, so the first stage rejects it. SQL has neither the fingerprints nor the tokenizer, so there
is no ORACLE_SQL; the tests hold each stage against a brute-force version.
"""

import public_tokenizers

from newsloom.llm.cascade import quality_rules as judged
from newsloom.llm.cascade import rule_order
from newsloom.llm.decontaminate import without_overlaps
from newsloom.llm.line_dedup import line_dedup as without_boilerplate
from newsloom.llm.packing import pack
from newsloom.llm.simhash import RADIUS, SHINGLE, one_of_each
from newsloom.session import cut_lineage


def quality_rules(spark, docs, sf_dir):
    return judged(docs, rule_order(docs), verdict="__kept").filter("__kept").drop("__kept")


def line_dedup(spark, docs, sf_dir):
    return without_boilerplate(docs).select(docs.columns)


def near_duplicates(spark, docs, sf_dir):
    return one_of_each(docs, radius=RADIUS, shingle=SHINGLE)


def decontaminate(spark, docs, sf_dir):
    return without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark, docs, sf_dir):
    return pack(docs, ["doc_id", "source"], public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
