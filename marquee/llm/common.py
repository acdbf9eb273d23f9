"""Helpers the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regex of the white space between words: space and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"
#: A table of hashes that every task gets: bits for each row it may be asked for, and at most 4 MB of them.
BITS_PER_ROW = 8
MAX_BITS = 1 << 25


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small: texts may be long, and a batch is held whole.

    Lowers ``spark.sql.execution.arrow.maxRecordsPerBatch`` where it is higher, and lets Python
    workers that share this file system import the library from where the driver has it.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return what a task has freed to the system: its worker lives on beside the next tasks."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def bits_for(rows: int) -> int:
    """How many bits a table of hashes gets that ``rows`` rows are held against."""
    return min(MAX_BITS, 1 << max(10, (BITS_PER_ROW * rows - 1).bit_length()))


def _place(column: Column, bits: int) -> tuple[Column, Column]:
    """Where a value has its bit: the row of the table, and the bit in it."""
    slot = F.pmod(F.xxhash64(column), F.lit(bits))
    return F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))


def bit_table(ids: DataFrame, column: str, bits: int) -> DataFrame:
    """(word, bits): a bit for the hash of each value of ``column``, 64 of them a row."""
    word, bit = _place(F.col(column), bits)
    return ids.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def marked(rows: DataFrame, column: str, table: DataFrame, bits: int, how: str = "left_semi") -> DataFrame:
    """All rows whose ``column`` is in the table, and few others; nothing is shuffled.

    With ``how`` ``left_anti`` the others: all of them are in none of its values.
    """
    word, bit = _place(rows[column], bits)
    met = (word == table["word"]) & (table["bits"].bitwiseAND(bit) != 0)
    return rows.join(F.broadcast(table), met, how)


def words_of(text: Column | str) -> Column:
    """Lower-case words between white space; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(F.lower(trimmed), SPACE)
    )


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % n
