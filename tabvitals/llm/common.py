"""What several operators share: folders that all executors see, words, hashes, Arrow batches."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes to lower-case (A-Z only); other bytes stay, also those of longer characters.
_LOWER = [c + 32 if 65 <= c <= 90 else c for c in range(256)]
#: Bytes that belong to words of letters, digits and all characters beyond ASCII.
_LETTERS = [48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in _LOWER]
_PLAIN = bytes(c if keep else 32 for c, keep in zip(_LOWER, _LETTERS, strict=True))

_MASK = (1 << 64) - 1


def plain_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased (A-Z) text."""
    return (text or "").encode().translate(_PLAIN).split()


def spaced_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the lower-cased (A-Z) text; null has none."""
    return (text or "").encode().lower().split()


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound: a look-up for known words."""

    MOST = 100_000  # some 15 MB of a worker, of which an executor has one per core

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix generator: every bit depends on all."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of `width` words, in order; of the whole if it is shorter."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        out = np.full(n, (0x9E3779B97F4A7C15 * width) & _MASK, np.uint64)
        for i in range(width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names in spark.checkpoint.dir.

    A session without the setting gets a folder of the warehouse, which a cluster shares too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/")
        root = f"{warehouse}/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """The frame, written to a shared folder and read from there: lost work is read, not redone."""
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def in_few_tasks(frame: DataFrame) -> DataFrame:
    """The frame in an eighth of the shuffle partitions, but in two for each core at least.

    For small shuffled tables, a few numbers for each link or bucket, as there are as many partitions
    as texts need. Each task writes a file, and without Hadoop's native library an executor starts
    processes (`chmod`) for each local file, which share all of its memory for a moment.
    """
    spark = frame.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return frame.coalesce(max(partitions // 8, 2 * spark.sparkContext.defaultParallelism))


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def sha256(column) -> F.Column:
    return F.sha2(column, 256)
