"""The queries of the text problems over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import leakage, mixing, truncation
from sluice.session import release, stored, table


def leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every leaked passage: the index is stored in the shared folder, searched for all items, and deleted."""
    index = stored(leakage.build_index(table(spark, d, "documents")), "p7-index", row_group_bytes=16 << 20)
    found = leakage.search(index, table(spark, d, "eval_items"))
    release(spark, "p7-index")
    return found


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that carry 20 or more successive words of a test item."""
    return leaks(spark, d).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """How many documents each leaked item stands in, and how much of it."""
    return leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("words").alias("longest"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mix: each text used, with its number of copies."""
    counted = stored(mixing.count_tokens(table(spark, d, "documents"), ["doc_id", "source"]), "p8-tokens")
    return mixing.mix(counted, table(spark, d, "mix_targets"), counted=counted)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share of all tokens that each source reached."""
    return mixing.shares(p8_mix(spark, d), table(spark, d, "mix_targets"))


def profiled(spark: SparkSession, d: str) -> DataFrame:
    return stored(truncation.profile(table(spark, d, "documents")), "p9-profile", "tag")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Texts that stop because the rest is lost."""
    return truncation.detect(profiled(spark, d)).select("doc_id")


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates."""
    return truncation.rates(profiled(spark, d))


QUERIES = {f.__name__: f for f in (p7_found, p7_leaks, p8_mix, p8_shares, p9_found, p9_rates)}
SQL: dict[str, str] = {}
