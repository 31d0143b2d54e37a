"""From raw documents to packed training sequences: five stages, each written and read again before the next.

Every stage takes all rows that the one before kept.  Low-quality documents go; of each group of near-duplicates the document with the
smallest id stays; documents that hold passages of the benchmark go; personal data gets surrogates; what is left is tokenised and
packed.  Near-duplicates are documents whose 64-bit SimHash fingerprints over three-word shingles differ in at most three bits.

Defined results: a null text counts as empty and stays null; texts without words have one fingerprint, so one of those that the
classifier keeps stays; documents without an id stay once for each fingerprint of a group without any id; rows that share id and
fingerprint are one document; other columns pass through all stages but the last, whatever their names, and ``n_chars`` follows
the text where there is such a column; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.llm import unused
from flatspan.llm.decontaminate import decontaminate
from flatspan.llm.packing import pack
from flatspan.llm.pii import pseudonymise
from flatspan.llm.quality import drop_low_quality
from flatspan.llm.simhash import drop_near_duplicates
from flatspan.session import write_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = pseudonymise(docs, kinds=unused(docs, "kinds")).select(docs.columns)
    if "n_chars" not in docs.columns:
        return text
    return text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("PII surrogates", personal_data),
    ("packing", packing),
]

#: The classifier is trained and the texts are tokenised, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
