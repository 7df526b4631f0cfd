"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.session import checkpoint_dir

#: The characters that separate words; every other character belongs to one.
BLANKS = " \t\n\x0b\x0c\r"
MASK64 = (1 << 64) - 1


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z (and only these) lower-cased, as UTF-8.

    ``bytes.lower`` touches ASCII alone and ``bytes.split`` separates at exactly BLANKS.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """Word -> 64-bit hash, remembering at most ``limit`` words (a cache; the hash never depends on it)."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def is_held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has this remainder (a NULL id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, for files that executors write or read."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read back: later steps start from these files."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """Tables of one job in the shared folder, one of a name: when a new one is complete, the one it replaces is deleted.

    Whatever still reads a replaced table must have been computed by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_folder(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.paths.pop(name, None)
        if path:
            jvm = self.spark._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def positions(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """rows with idx, the position in their tree by ``order``, and n, the tree's number of rows.

    Rows are range partitioned by tree and order and numbered inside partitions; the counts per partition and
    tree are summed up before them.  Rows equal in all of ``order`` are spread by a seeded random number, so one
    repeated row does not fill a partition.
    """
    spread = rows.withColumn("_spread", F.rand(7))
    keys = [tree, *order, "_spread"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = spread.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_spread")
    schema = T.StructType([*ranged.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_pos", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = batch.column(tree).dictionary_encode()
            codes = runs.indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            first_tree = runs.dictionary[codes[0]].as_py()
            offset = np.zeros(len(codes), np.int64)
            if first_tree == last:
                offset[: starts[1] if len(starts) > 1 else len(codes)] = seen
            base = np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
            pos = np.arange(len(codes)) - base + offset
            last, seen = runs.dictionary[codes[-1]].as_py(), int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(codes), part), pa.int32()), pa.array(pos)],
                                             names=schema.names)

    numbered = written(ranged.mapInArrow(number, schema), name)
    counts = numbered.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(tree)
    before = counts.select(tree, "_part", F.sum("_c").over(w).alias("n"), (F.sum("_c").over(w.orderBy("_part")) - F.col("_c")).alias("_before"))
    placed = numbered.join(before, [tree, "_part"])
    return placed.withColumn("idx", F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_before")
