"""The corpus pipeline over ``documents``.

Five stages, each of which calls one operator of ``keyflow.llm``, works on all
rows that its predecessor kept, and is written as Parquet and read again as the
next one's input.  All but the last return the columns of ``documents``.

No stage can be expressed in SQL as a whole (learned scores, sampling, token
ids), so ``ORACLE_SQL`` is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keyflow.llm import bpe, jaccard, mixing, secrets, toxicity
from keyflow.llm.common import prepare, saved, table


def toxic_documents(spark, docs, sf_dir):
    """Documents that the toxicity model rejects go; labels are learned as in query op10."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.accepted(docs, labels)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of similar documents the one with the smallest id stays."""
    prepare(spark)
    return jaccard.first_of_each(docs)


def secret_scans(spark, docs, sf_dir):
    """Secrets are replaced by ``[SECRET]``; every document stays, ``n_chars`` follows the text."""
    prepare(spark)
    clean = secrets.redacted(docs)
    n_chars = F.when(F.col("text").isNotNull(), F.length("text").cast("long"))
    return clean.withColumn("n_chars", n_chars).select(*docs.columns) if "n_chars" in docs.columns else clean


def mixing_sources(spark, docs, sf_dir):
    """Each source comes to its target: documents are left out, kept once or taken twice."""
    prepare(spark)
    return mixing.mixed(docs)


def bpe_encoding(spark, docs, sf_dir):
    """Token ids of every text, and how many."""
    prepare(spark)
    import public_tokenizers

    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxic_documents),
    ("jaccard_join", near_duplicates),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
    ("bpe_encoding", bpe_encoding),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
