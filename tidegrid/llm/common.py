"""Plumbing shared by the training-data operators: the shared folder, written tables, words, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Keeps Arrow batches small, so that a batch of very long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``; a temporary folder only where that is unset and Spark is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidegrid-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidegrid-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there, and a lost executor costs no more than its tasks. Its shuffle files go when the write is done."""
    spark, path = df.sparkSession, path or shared_dir(df.sparkSession)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of written tables that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: Python workers live on, beside others and the JVM."""
    import ctypes
    import gc

    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, name: str = "_doc") -> DataFrame:
    """docs as one struct column, so that no column of theirs can clash with an operator's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(name))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text (see WORD) in UTF-8; bytes.split() cuts at the same six characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_count(column: str) -> F.Column:
    """Number of words, 0 for null; runs in the JVM."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 joined by edges a-b: the smallest node of each node's component."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        new = label.copy()
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        while not np.array_equal(new, hop := new[new]):
            new = hop
        if np.array_equal(new, label):
            break
        label = new
    return label


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that join what the edges a-b join: fewer edges than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = nodes[labels_of(len(nodes), at[: len(a)], at[len(a) :])]
    keep = root != nodes
    return nodes[keep], root[keep]


def _forests(batches: Iterable) -> Iterator:
    import pyarrow as pa

    kept = [np.empty(0, np.int64), np.empty(0, np.int64)]
    for x in batches:
        kept = list(forest(*(np.concatenate([k, np.asarray(x.column(i))]) for i, k in enumerate(kept))))
    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()) for k in kept], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, root), root being the smallest node of the component.

    Each partition first replaces its edges by a spanning forest. Then rounds of large-star and small-star run
    until nothing changes. Minima are aggregated before the shuffle and written, so that both sides of each join
    are plain exchanges, whose hot keys Spark splits. Self-loops and edges with a null are left out. No edges: no rows.
    """
    e = written(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).mapInArrow(_forests, "u long, v long"))
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v")).distinct())
        seen = now
        both = e.union(e.select("v", "u"))
        low = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = written(large.distinct())
        low = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct())
