"""Helpers of the operators: stored intermediate tables, input tables, word pattern, memory of workers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is unset and the session runs in one process (``local[...]``), a
    temporary folder is made and used from then on; a cluster without the setting is refused.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        root = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, *, codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    This cuts the lineage (a lost executor re-reads files instead of recomputing), fixes what
    later passes see, and gives the optimizer the true size for its choice of joins.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(docs: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns besides ``used`` under names that no operator uses, and how to get its columns back from a result."""
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in docs.columns}
    names = {c: c if c in used else f"extra_{k}" for k, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(quoted[c]).alias(names[c]) for c in docs.columns])
    return inner, lambda out: out.select(*[F.col(names[c]).alias(c) for c in docs.columns])


def parts(amount: int, each: int) -> int:
    """How many parts of ``each`` hold ``amount``; at least one."""
    return max(1, -(-int(amount or 0) // each))


def word_count(text):
    """Number of words (runs without ASCII white space); null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def give_back() -> None:
    """What a worker has freed goes back to the system; else an idle worker keeps the most that it ever used, stage after stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidy_task(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives memory back when its task ends."""

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """A function ``(key, rows)`` for ``applyInArrow`` that gives memory back after each group."""

    def tidied(key, rows):
        out = run(key, rows)
        give_back()
        return out

    return tidied


def tidy_pair(run: Callable) -> Callable:
    """The same for ``(key, left, right)`` of a cogroup."""

    def tidied(key, left, right):
        out = run(key, left, right)
        give_back()
        return out

    return tidied
