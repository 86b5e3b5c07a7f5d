"""A filter that keeps the rows of some keys before they are shuffled, however many keys there are.

The filter is a blocked Bloom filter made of ordinary rows: a key belongs to one block by its hash and sets a few of the
64 bits there, and an aggregation ORs the bits of a block. It is applied as a broadcast join by block and a test of the
bits, so scans stay in generated code and other rows end there, but for a bounded share that is sorted out by the exact
join behind it. Its size is bounded: beyond ``KEYS_AT_ONCE`` keys are sieved in several passes, each for its own part of
the keys, and a row is kept by one pass at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.tables import scratch_path, snapshot

#: Blocks of a filter at most, of 16 bytes each, and keys of a pass.
BLOCKS, KEYS_AT_ONCE = 1 << 20, 1 << 24
#: Keys per block, up to so many, and bits that a key sets then; the share of other rows that pass is about 1, 3 and 15 %.
_BITS = ((4, 4), (8, 3), (16, 2))


def _shape(n: int) -> tuple[int, int]:
    """Blocks and bits per key for n keys."""
    blocks = min(BLOCKS, max(16, -(-n // _BITS[0][0])))
    return blocks, next((bits for keys, bits in _BITS if n <= keys * blocks), 1)


def _place(key: str, blocks: int, bits: int) -> tuple[str, str]:
    """SQL for the block of a key and its bits there."""
    parts = [f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64(1, {key}), {6 * k}) & 63 AS INT))" for k in range(bits)]
    return f"pmod(xxhash64(0, {key}), {blocks}L)", " | ".join(parts)


def sieved(df: DataFrame, key: str, keys: DataFrame, key_of: str, n: int) -> DataFrame:
    """The rows of ``df`` whose ``key`` (SQL) may be among the ``n`` keys ``key_of`` (SQL) of another frame.

    Above ``KEYS_AT_ONCE`` the rows that pass are written to the shared folder, pass by pass.
    """
    passes = max(1, -(-n // KEYS_AT_ONCE))
    if passes == 1:
        return _sifted(df, key, keys, key_of, n)
    path = scratch_path(df.sparkSession, "sieved")
    part = "pmod(xxhash64(2, {}), {}L) = {}"
    for k in range(passes):
        some = keys.filter(part.format(key_of, passes, k))
        _sifted(df.filter(part.format(key, passes, k)), key, some, key_of, -(-n // passes)).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sifted(df: DataFrame, key: str, keys: DataFrame, key_of: str, n: int) -> DataFrame:
    blocks, bits = _shape(n)
    block, mask = _place(key_of, blocks, bits)
    table = keys.selectExpr(f"{block} AS __block", f"{mask} AS __mask").groupBy("__block").agg(F.expr("bit_or(__mask) AS __bits"))
    table = snapshot(table, "sieve")
    block, mask = _place(key, blocks, bits)
    hit = df.selectExpr("*", f"{block} AS __block", f"{mask} AS __mask").join(F.broadcast(table), "__block")
    return hit.filter("(__bits & __mask) = __mask").drop("__block", "__bits", "__mask")
