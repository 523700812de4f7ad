"""Written intermediate tables and connected components.

A step stays until ``drop`` (its last reader is written) or until the ``steps_removed`` block that it was written in
ends; the result of an operator may read steps, so a caller ends the block after writing that result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from designlab.session import checkpoint_dir


#: folder of each step that is still known, and what the open ``steps_removed`` blocks do at their ends
_FOLDER: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_BLOCKS: list[list[Callable[[], object]]] = []


def at_end(remove: Callable[[], object]) -> None:
    """Call ``remove`` when the innermost open ``steps_removed`` block ends (never, if none is open)."""
    if _BLOCKS:
        _BLOCKS[-1].append(remove)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name in the shared checkpoint folder; an open ``steps_removed`` block removes it at its end."""
    path = f"{checkpoint_dir(spark)}/{kind}_{uuid.uuid4().hex}"
    at_end(lambda: remove_folder(spark, path))
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system (nothing happens if it is not there)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def has_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action inside the block go when it ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back; its shuffles go at once."""
    path = new_folder(df.sparkSession, "stored")
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDER[out] = path
    return out


def drop(*steps: DataFrame) -> None:
    """Delete stored steps that nothing reads any more."""
    for step in steps:
        remove_folder(step.sparkSession, _FOLDER.pop(step))


@contextmanager
def steps_removed() -> Iterator[None]:
    """Folders and tables that operators make inside the block go at its end, whether or not it fails."""
    _BLOCKS.append([])
    try:
        yield
    finally:
        for remove in reversed(_BLOCKS.pop()):
            remove()


def plain_names(docs: DataFrame) -> DataFrame:
    """``docs`` with every column but doc_id and text renamed by position, so that no helper column clashes."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable over ``edges`` (a, b), for every node that has an edge.

    Large-star and small-star rounds (Kiveris et al., 2014): larger neighbours of a node move to its smallest one,
    then the smaller ones do, until every node points at its component's smallest; rounds grow with the logarithm
    of a chain's length, not with the length.  Links are written each round, so lineage stays short.
    """
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = stored(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        near = large.join(large.groupBy("a").agg(F.min("b").alias("low")), "a")
        small = stored(near.select("a", F.col("low").alias("b"))
                       .union(near.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct())
        drop(links, large)
        links, was = small, state
        state = _state(links)
        if state == was:
            return links.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(links.select("b", "b").distinct())


def _state(links: DataFrame):
    """Number of links and sum of their hashes: equal for equal sets."""
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
