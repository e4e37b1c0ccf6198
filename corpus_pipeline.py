"""Documents to packed sequences: the stages of the training-data pipeline.

Each stage takes (spark, docs, sf_dir). Its result is written as Parquet in the shared folder and read
again as the next stage's documents, so no stage repeats the work of those before it. All but the
last return the columns of documents; the last returns packed pieces with their token ids.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm import decontaminate, language_ppm, packing, pii_feistel, simhash_pivots
from folioflow.llm.pii_query import KEY
from folioflow.llm.scratch import discard, discard_since, free_name, made_so_far, written
from folioflow.session import ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, missing labels filled in; texts without letters, or null, go.

    Repeated rows get the same answer; without a labelled text every document goes.
    """
    ship_package(spark)
    model = language_ppm.fit(docs.where(~language_ppm.held_out()))
    told = free_name(docs, "told")
    named = docs.withColumn(told, language_ppm.identify("text", model))
    known = named.where(F.col(told)["lang_pred"] != language_ppm.UND)
    return known.withColumn("lang", F.coalesce("lang", F.col(told)["lang_pred"])).drop(told)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of three-word shingles link at three bits or fewer.

    The smallest id stays, null last; equal rows count as copies; null and empty texts are one group.
    """
    ship_package(spark)
    return simhash_pivots.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data under pseudonyms; null texts stay null, repeated rows stay."""
    made = pii_feistel.pseudonymize(docs, KEY)
    return made.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their place; a null or empty text is one piece with its end id."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

# Language models, fingerprints and tokenizers are beyond SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        begun = made_so_far()
        docs, path = written(stage(spark, docs, sf_dir), name)
        discard_since(spark, begun, keep=path)
        if before:
            discard(spark, before)
        before = path
    return docs
