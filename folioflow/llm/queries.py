"""The queries of this subpackage and the SQL that checks them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from . import best_fit_query, chat_query, collocations_query, decontaminate_query, html_query, language_query, line_rules_query, packing_query, periodic_runs_query, pii_query, simhash_query, suffix_query, toxicity_query  # noqa: E402,F401
