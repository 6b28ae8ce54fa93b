"""Helpers shared by the operators: table columns, staged tables, and text as byte arrays."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.session import new_workspace

#: White space of the contracts: space and the bytes 09 to 0D.
SPACE_RE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text that the array code handles at a time; a longer text is handled alone.
BLOCK_BYTES = 1 << 20
#: The same where each byte takes many numbers; they stay in a core's cache.
FINE_BYTES = 1 << 18
#: Bytes of rows that go to a Python worker at a time, and Spark's own bound for them.
BATCH_BYTES, BATCH_KEY, BATCH_DEFAULT = 1 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15


def narrow(table: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, found by exact name and position.

    Further columns may have any names, also ones that differ in case only or that an operator
    uses for its results.
    """
    places = [table.columns.index(name) for name in names]
    plain = table.toDF(*[f"_c{k}" for k in range(len(table.columns))])
    return plain.select(*[F.col(f"_c{k}").alias(name) for k, name in zip(places, names)])


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and the columns asked for."""
    picked = narrow(docs, "doc_id", "text", *more)
    return picked.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of 1 MB, unless the session has a bound of its own.

    By default a batch holds up to 10,000 texts or 64 MB, which JVM and worker hold at once, several
    times while buffers double. The setting stays with the session, as results are read lazily; it
    changes no result.
    """
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def staged(table: DataFrame, purpose: str, spark: SparkSession) -> DataFrame:
    """The table written below the shared folder and read back; cuts lineage for good."""
    path = new_workspace(spark, purpose)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def without_rows(schema: str, spark: SparkSession) -> DataFrame:
    """A table of that schema without rows. ``createDataFrame`` of a list starts Python workers of its own, also for none."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


#: Where a worker keeps the tokenizer's table of units from task to task.
KEPT_UNITS = "_tallymart_kept_units"


def tidy(rows: Callable[..., Iterator], forget: bool = True) -> Callable[..., Iterator]:
    """A generator that a Python worker runs, which leaves the worker small for the stages after.

    Workers stay, and so would the memory that a task has freed. With ``forget`` what packing
    has kept goes too.
    """

    @functools.wraps(rows)
    def tidied(*args):
        if forget:
            sys.modules.pop(KEPT_UNITS, None)
        try:
            yield from rows(*args)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim:
                trim(0)

    return tidied


#: Bits of the map that tells texts without marks apart before they are moved.
SIEVE = 1 << 24


def sifted(rows: DataFrame, marked: DataFrame, key: list[str], hit: bool = True) -> DataFrame:
    """Rows that may be among ``marked`` (or that cannot be), by a bit map of bounded size.

    The map is one row that is broadcast, so no Python runs here: a second worker a task would stay.
    It spares a move to texts that surely have no marks. A row that passes may still have
    none: the join behind it decides. With very many marks the map fills and spares nothing.
    """
    cell = F.pmod(F.xxhash64(*key, F.lit(5)), F.lit(SIEVE)).cast("int")
    cells = marked.select(cell.alias("cell")).distinct().toArrow().column("cell").to_numpy()
    bits = np.zeros(SIEVE, bool)
    bits[cells] = True
    words = np.packbits(bits, bitorder="little").view("<i8")
    sieve = rows.sparkSession.createDataFrame(pa.table({"_sieve": pa.array([words], pa.list_(pa.int64()))}))
    passes = F.getbit(F.get("_sieve", F.shiftright(cell, 6)), cell.bitwiseAND(F.lit(63))) == 1
    return rows.join(F.broadcast(sieve), passes, "left_semi" if hit else "left_anti")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_blocks(column, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of an Arrow string column in runs of about ``limit`` bytes.

    Yields first row, row past the last, the bytes, and where each text starts among them (with
    the end of the last). A text is never split.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    starts = starts.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        own = starts[row : end + 1]
        yield row, end, data[own[0] : own[-1]], own - own[0]
        row = end


def spread(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one space behind each, and where each starts; no word crosses texts."""
    n = len(starts) - 1
    raw = memoryview(np.ascontiguousarray(data))
    joined = b" ".join([raw[starts[k] : starts[k + 1]] for k in range(n)]) + b" "
    return np.frombuffer(joined, np.uint8), starts[:-1] + np.arange(n)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in bytes that end with a space."""
    solid = ~IS_SPACE[data]
    edges = np.flatnonzero(np.diff(solid.view(np.int8), prepend=np.int8(0)))
    return edges[0::2], edges[1::2]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    out = values >> np.uint64(30)
    out ^= values
    out *= MIX_1
    high = out >> np.uint64(27)
    out ^= high
    out *= MIX_2
    out ^= np.right_shift(out, np.uint64(31), out=high)
    return out


#: A prime below 2**31 and a base for it; words whose hashes modulo 2**64 agree differ here.
PRIME, PRIME_BASE = (1 << 31) - 1, 1_355_072_483
#: Bytes that are summed up before the sum is taken modulo the prime.
PRIME_RUN = 1 << 18


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64 and modulo a prime, as many as were needed so far."""

    def __init__(self, base: int = BASE) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)
        self.prime_up = self.prime_down = np.ones(1, np.int64)

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            have = len(self.up)
            step, back = (np.uint64(pow(x, have, 1 << 64)) for x in (self.base, self.inverse))
            self.up = np.concatenate([self.up, self.up * step])
            self.down = np.concatenate([self.down, self.down * back])
        return self.up[:n], self.down[:n]

    def first_of_prime(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.prime_up) < n:
            have = len(self.prime_up)
            step, back = pow(PRIME_BASE, have, PRIME), pow(PRIME_BASE, -have, PRIME)
            self.prime_up = np.concatenate([self.prime_up, self.prime_up * step % PRIME])
            self.prime_down = np.concatenate([self.prime_down, self.prime_down * back % PRIME])
        return self.prime_up[:n], self.prime_down[:n]


def prime_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 31-bit hash of each span, as a polynomial modulo the prime."""
    up, down = powers.first_of_prime(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.int64)
    for a in range(0, len(data), PRIME_RUN):
        own = data[a : a + PRIME_RUN]
        np.cumsum((own.astype(np.int64) + 1) * up[a : a + len(own)], out=sums[a + 1 : a + 1 + len(own)])
        if a:
            sums[a + 1 : a + 1 + len(own)] += sums[a] % PRIME
    return (sums[ends] % PRIME - sums[starts] % PRIME) % PRIME * down[starts] % PRIME


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of each span of the bytes; equal bytes give equal hashes wherever they stand.

    Made of polynomials modulo 2**64 and modulo a prime. The first alone is the same for some long
    words in Thue-Morse order, whatever its base.
    """
    up, down = powers.first(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    plain = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    return mixed(plain ^ mixed(prime_hashes(data, starts, ends, powers).astype(np.uint64) + np.uint64(BASE)))
