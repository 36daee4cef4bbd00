"""One query per operator of this package, over its whole table, with production parameters."""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabvitals.llm import (
    bpe,
    decontaminate,
    katz,
    licenses,
    lines,
    merkle,
    near_dups,
    pii,
    quality,
    secrets,
    sharding,
    spelling,
    warc,
)
from tabvitals.llm.common import documents, shared_folder

SHARDS = [f"shard-{i:02d}" for i in range(64)]


def checksum(key: str) -> Column:
    """The checksum of a key in decimal; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")))


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Base phrases and licences of every document."""
    return licenses.digest(licenses.scanned(documents(spark, folder)))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that documents hold, also edited."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.found(documents(spark, folder), items)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, votes, quality and verdict of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    return quality.scored(docs, "text").drop("text")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, written to a WARC archive and read back from it."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return warc.round_trip(pages, shared_folder(spark, "warc"))


def op5_bpe(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text of every document."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return bpe.coded(documents(spark, folder), bpe.load(path), with_ids=False)


def op6_katz(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document, by a model of those of four of five remainders of a checksum."""
    docs = documents(spark, folder).select("doc_id", "text")
    return katz.scored(docs, checksum("doc_id") % 5 != 1)


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document."""
    return secrets.digest(secrets.found(documents(spark, folder)))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document, by its id."""
    return sharding.place(documents(spark, folder).select("doc_id"), "doc_id", SHARDS)


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near-duplicates of every document, by runs of two words."""
    rows = near_dups.grouped(documents(spark, folder), width=2)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    docs = documents(spark, folder).select("doc_id", "source", "text")
    return lines.without_boilerplate(docs, "source", "text")


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data of every document."""
    return pii.digest(pii.found(documents(spark, folder)))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents with their forms; one in 199 runs loses a character."""
    return spelling.grouped(documents(spark, folder), thin=199)


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Digests and proof of every document, checked against a copy of which half lost line ends."""
    text = F.translate("text", "\n", "")
    rows = merkle.manifest(documents(spark, folder), checksum("doc_id") % 2 == 0, text)
    return rows.drop("place")


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_decontamination": op2_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc": op4_warc,
    "op5_bpe": op5_bpe,
    "op6_katz": op6_katz,
    "op7_secrets": op7_secrets,
    "op8_sharding": op8_sharding,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_line_dedup": op10_line_dedup,
    "op11_pii": op11_pii,
    "op12_spelling": op12_spelling,
    "op13_merkle": op13_merkle,
}
