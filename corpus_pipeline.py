"""Documents made ready for training, one written table after another.

STAGES lists the stages in order. Each takes the session, the documents that the stage before it
kept, and the folder of the tables, and works on all of them. All but the last return the columns
of the documents; the last returns their tokens.

Documents that the label model rejects go, then lines that are boilerplate of their source; of the
texts that are left, one of each group of near-duplicates stays (runs of five words, similarity of
0.8), and those that hold a benchmark item go. The rest is encoded.

Null and empty texts have no words, so quality rejects them. A document whose lines all go keeps
its row with an empty text; such rows form no groups, hold no items and have no tokens. Of
repeated rows one stays. Rows without id or source are documents like others, further columns are
kept as they are (`n_chars` follows the text), and empty tables give empty ones.

An executor's memory is shared by all stages: its Python workers stay, with what they keep, when the
next stage begins. So texts go to Python in small batches, a setting that the session keeps, and
encoders keep fewer words than those of `op5_bpe`; both cost time only.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabvitals.llm import bpe, decontaminate, lines, near_dups, quality
from tabvitals.llm.common import written

BATCH = "4m"  # bytes that go to Python at once; 10,000 whole texts otherwise
KEPT_WORDS = 100_000  # of a generation; an executor has an encoder per core


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of some `BATCH` bytes, unless the session has a limit of its own.

    For each core an executor holds a batch in Arrow, again as it is sent, and in Python.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH)


def drop_low_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that are good by the rules' votes."""
    small_batches(spark)
    return quality.without_rejects(docs, "text")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without lines that over a tenth of the documents of their source have."""
    cut = lines.without_boilerplate(docs, "source", "text", counts=False)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return near_dups.without_copies(docs, "doc_id", "text")


def drop_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    small_batches(spark)
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return docs.filter(~decontaminate.holds(F.col("text"), items))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token ids of each document, their number, and digests of ids and decoded text."""
    small_batches(spark)
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.coded(docs, vocabulary, "doc_id", "text", kept_words=KEPT_WORDS)


STAGES = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_boilerplate),
    ("near-duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("encoding", encode),
]

#: SQL has no label model, edit distance of passages or BPE; a brute-force version tests run().
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, one after another, over the table of documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
