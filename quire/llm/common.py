"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import find_package, shared_folder

#: Word patterns of the contracts, in the syntax that Java, RE2 and Python share.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: bytes.translate table: A-Z to a-z, every other ASCII byte outside [0-9a-z] to a space.
#: ``bytes.split()`` of the result gives the ALNUM_WORD words of the lower-cased text,
#: since every byte of a non-ASCII code point is 0x80 or more.
ALNUM_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return find_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session."""
    return shared_folder(find_package(spark))


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/quire/{re.sub(r'[^A-Za-z0-9_-]', '_', tag)}-{uuid.uuid4().hex}"


_recorded: list[str] | None = None


@contextmanager
def recording():
    """The folders that ``materialize`` makes inside, for a caller to drop once nothing reads them."""
    global _recorded
    before, _recorded = _recorded, []
    try:
        yield _recorded
    finally:
        _recorded = before


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a lost
    executor costs nothing that was computed before this point."""
    spark = df.sparkSession
    path = new_folder(spark, tag)
    df.write.parquet(path)
    if _recorded is not None:
        _recorded.append(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this module's making through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_state: dict = {}


def worker_state(key, make):
    """What a Python worker keeps between tasks (a tokenizer's cache, a model's words): one thing at a
    time. Workers are reused, so an operator that asks for its own lets go of what another one kept."""
    if key not in _state:
        _state.clear()
        _state[key] = make()
    return _state[key]


def no_worker_state() -> None:
    """For operators that keep nothing: let go of what another one kept."""
    _state.clear()


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def ascii_lower(col):
    """A-Z to a-z and nothing else (``lower`` would also change other alphabets)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
