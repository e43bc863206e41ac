"""What the operators share: the shared folder, written intermediate tables, word rules."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.shared import forget, materialise, new_folder, settled, shared_folder  # noqa: F401

# Arrow's own pools keep what batches have freed; a worker lives on from one stage to the next
pa.set_memory_pool(pa.system_memory_pool())

#: A word is a run of anything but ASCII white space; bytes.split() follows the same rule.
WORD = r"[^\x20\x09-\x0D]+"


def release() -> None:
    """Give a Python worker's free memory back to the system, since workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def unused(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_sample(rows: DataFrame, taken: DataFrame, key: str, column: str, most_bytes: int) -> pd.DataFrame:
    """The rows' column for the keys that are taken, with what taken says of them, in the order of the keys.

    taken (key, _bytes, ...) has been limited to a few thousand rows. Keys are
    taken in their order as long as their bytes add up to at most most_bytes,
    so what reaches the driver is bounded; of rows with one key, one comes.
    """
    wanted = taken.toPandas().sort_values(key).reset_index(drop=True)
    wanted = wanted[wanted["_bytes"].cumsum() <= most_bytes]
    kind = taken.select(key).schema
    keys = rows.sparkSession.createDataFrame([(k,) for k in wanted[key].tolist()], kind)
    # as few keys as taken has, so the small side is bounded
    got = rows.select(key, column).join(F.broadcast(keys), key).groupBy(key).agg(F.min(column).alias(column)).toPandas()
    return got.merge(wanted, on=key).sort_values(key).reset_index(drop=True)


_kept: dict[object, object] = {}


def kept(name: object, make: Callable[[], object]) -> object:
    """What this worker process keeps between tasks under a name.

    Another name takes its place, so that a worker, which lives on from one
    operator to the next, holds one memory of words at a time.
    """
    if name not in _kept:
        _kept.clear()
        gc.collect()
        release()
        _kept[name] = make()
    return _kept[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def content(column: str = "text") -> Column:
    """The text's UTF-8 bytes; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def word_count(column: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(WORD)).cast("long")
