"""The corpus pipeline: documents through five operators, each step written as Parquet and read again.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Rows that a stage drops are
gone for the next one: low quality, near copies but for one of each group, contaminated documents. Secrets are replaced
in the text, whose n_chars is then counted anew. The last stage returns token counts and digests.

Edge cases: a null, empty or wordless text fails the quality rules (too few words), so later stages of run() never see
one; called by themselves they keep it: it is near nothing, has no window and no secret, and no tokens. Of equal texts, and
of a group of near copies, the document of the smallest id stays; rows that repeat an id are one document, of which one
row stays. A row without id always stays. Columns are taken by the names of documents; others pass through. Empty tables of documents give empty results, and an empty benchmark drops nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logspark.llm import bpe, decontaminate, minhash, quality, secrets
from logspark.llm.queries import VOCABULARY, table
from logspark.llm.tables import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, count_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("bpe encoding and decoding", tokens),
]

#: Shingle links, tokenizer ids and digests are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
