"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

toxicity         documents predicted toxic go; the model learns from the rows not held out
exact dedup      of equal texts the smallest id stays
near duplicates  of each component of the Jaccard join the smallest id stays
mixing           documents are repeated or left out, so that each source has its target of words
packing          the mix as pieces in sequences of 1024 tokens

The stages before packing return the columns of ``documents``. What each does with nulls, empty texts,
ties, repeated rows and empty tables is said in its operator.
"""

from __future__ import annotations

from tripmill.llm import exact_dedup, jaccard, mixing, packing, toxicity
from tripmill.llm.catalogue import PATTERN, TOKENIZER
from tripmill.llm.common import stored, table

#: Learned word lists, token ids and components have no SQL; the tests follow each stage by brute force.
ORACLE_SQL = None


def not_toxic(spark, docs, sf_dir):
    return toxicity.keep(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact(spark, docs, sf_dir):
    return exact_dedup.keep(docs)


def near(spark, docs, sf_dir):
    return jaccard.keep(docs)


def mixed(spark, docs, sf_dir):
    return mixing.mixed(docs)


def packed(spark, docs, sf_dir):
    return packing.pack_documents(docs, TOKENIZER, PATTERN)


STAGES = [("toxicity", not_toxic), ("exact dedup", exact), ("near duplicates", near), ("mixing", mixed), ("packing", packed)]


def run(spark, sf_dir):
    """All stages over the table ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
