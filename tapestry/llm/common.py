"""Shared pieces of the corpus operators: the shared folder, the input tables and the white space of the contracts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FIRST = -(1 << 63)  # a null doc_id sorts before every other
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset (tests), it is set to a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table that is read more than once to the shared folder and read it back.

    Cuts the lineage: a lost executor only repeats scans of the written table.  Spark is asked to drop the shuffle files of
    the write when it is done, as nothing reads them again.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, label)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, which the cluster sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def text_hash(text: str) -> Column:
    return F.xxhash64(whole(text))


def row_key(doc_id: Column, hashed: Column, *more: Column) -> Column:
    """What tells rows apart that may share a doc_id: the id and a hash of the text; nulls have a place of their own."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id.cast("long"), hashed, *more)])


def spare(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def restrict(docs: DataFrame, stay: DataFrame, id_col: str = "doc_id", text_col: str = "text", one: bool = False) -> DataFrame:
    """The rows of ``docs``, with all columns, whose id and text are in ``stay`` (doc_id, text_hash); ``one``: one row of each."""
    key, nth = spare(docs, "__key", "__nth")
    keys = stay.select(row_key(F.col("doc_id"), F.col("text_hash")).alias(key))
    rows = docs.withColumn(key, row_key(F.col(id_col), text_hash(text_col))).join(keys, key, "left_semi")
    if one:
        rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))).filter(F.col(nth) == 1)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
