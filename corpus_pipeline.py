"""From documents to a training mix: every stage takes the documents that the
stage before kept, as a DataFrame, and works on all of them.

1. language ID      documents whose language is not recognised go
2. jaccard join     one document of each group of near copies stays
3. decontamination  documents that hold a benchmark window go
4. pii              personal data is replaced by its kind
5. mixing           words taken of each document by the sources' target weights

Stages 1 to 4 return the columns of documents, the last one adds size, source_size,
target and taken (documents of which nothing is taken are left out).

An empty table gives no rows.  Null and empty texts hold no language and go in the first stage.  Equal
rows are copies of each other, of which one stays; a null doc_id has no copies.  Very long texts are
whole in every stage.  Extra columns stay, but those named as the last stage's own are its.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnout.llm import decontaminate, jaccard, langid, mixing, pii
from turnout.llm.common import prepare, stored, table

STAGES = [
    ("language_id", langid.stage),
    ("ngram_jaccard_join", jaccard.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("pii", pii.stage),
    ("source_mixing", mixing.stage),
]

#: SQL cannot express the language models and the random field; tests hold
#: each stage and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
