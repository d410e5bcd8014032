"""What the corpus operators share: shared storage, lineage cuts, size-checked broadcasts, tokens."""

from __future__ import annotations

import sys
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

#: Rows and bytes that a side may have to be broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64_000_000


def ship_by_value(module_name: str) -> None:
    """Send a module's kernels to the workers by value, so that they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, also set as checkpoint folder.

    It is ``spark.checkpoint.dir`` where that is set, else the folder given to
    ``setCheckpointDir``, else the warehouse; a temporary folder serves local masters only.
    """
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if held.isDefined():
        return named or held.get()
    if not named:
        local = sc.master == "local" or sc.master.startswith("local[")
        named = tempfile.mkdtemp(prefix="transpark-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    sc.setCheckpointDir(named)
    return named


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as a table in the shared folder and read from there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(value: Column, kind: DataType) -> Column:
    """About the bytes of a value."""
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, StructType):
        size = sum((_width(value[f.name], f.dataType) for f in kind), F.lit(0))
    elif isinstance(kind, ArrayType):
        fixed = not isinstance(kind.elementType, (StringType, BinaryType, StructType, ArrayType, MapType))
        size = F.size(value) * 8 if fixed else F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _width(x, kind.elementType))
    elif isinstance(kind, MapType):
        size = F.octet_length(F.to_json(value))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size.cast("long"), F.lit(0).cast("long")) + 8


def small_or_not(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a side for broadcast if its rows, and their bytes, stay below a bound.

    Call it on checkpointed (or otherwise cheap) frames: they are counted here.
    """
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0).cast("long"))
    n, total = df.agg(F.count("*"), F.sum(width)).first()
    return F.broadcast(df) if n <= rows and (total or 0) <= size else df


def word_lists(texts: list) -> list[list[bytes]]:
    """Lower-cased (A-Z) words between ASCII white space, as UTF-8; null has none."""
    return [(t or "").encode().lower().split() for t in texts]


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter(map(h, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


ship_by_value(__name__)
