"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorlens.session import stored  # noqa: F401

#: Text bytes that one Python task handles at a time; bounds its memory, not its input.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def salted_join(rows: DataFrame, groups: DataFrame, on: list[str], how: str = "left", salts: int = 32) -> DataFrame:
    """Join ``groups``, one row a key, to ``rows`` of which one key may hold any share.

    Each group row is repeated for every salt, so a key's rows meet it in ``salts`` tasks.
    """
    salt = "__salt"
    while salt in rows.columns or salt in groups.columns:
        salt += "_"
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int"))
    every = groups.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every, [*on, salt], how).drop(salt)


def bit_table(rows: DataFrame, slots: int, slot: str = "slot") -> np.ndarray:
    """Which of ``slots`` (a multiple of 32,768) numbers occur in column ``slot``.

    Spark builds the bits in pieces, so slots / 8 bytes reach the driver at any number of rows.
    """
    at = F.col(slot) + 1
    pieces = rows.groupBy(F.bitmap_bucket_number(at).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    table = np.zeros(slots // 8, np.uint8)
    for piece, bits in pieces.toLocalIterator():
        table[(piece - 1) * len(bits):piece * len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return table


def has_bit(table: np.ndarray, slot):
    """Whether the bits of ``slot`` (a number or an array) are set in a ``bit_table``."""
    return table[slot >> 3] >> (slot & 7) & 1 == 1


def worker_cache(name: str, limit: int = 0) -> dict:
    """A dict that lives as long as the Python worker process, shared by its tasks.

    Emptied when it holds more than ``limit`` entries (0: never).
    """
    cache = _worker_caches().setdefault(name, {})
    if limit and len(cache) > limit:
        cache.clear()
    return cache


def let_go(*kept: str) -> None:
    """Empties the worker's caches but for those ``kept``: what tasks of other operators have left in its process."""
    for name, cache in _worker_caches().items():
        if name not in kept:
            cache.clear()


def _worker_caches() -> dict[str, dict]:
    home = sys.modules.setdefault("_vendorlens_worker", types.ModuleType("_vendorlens_worker"))
    return home.__dict__.setdefault("caches", {})


def text_blocks(batches, text: str = "text", block_bytes: int = BLOCK_BYTES):
    """Slices of Arrow record batches with about ``block_bytes`` of ``text`` each."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > block_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin)


def texts(batch, name: str = "text") -> list[str]:
    """The strings of a column, null as the empty string."""
    return [x or "" for x in batch.column(name).to_pylist()]


def utf8(batch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty, without decoding them."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def as_sql_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
