"""Deterministic randomness: every random draw is a hash of (key, seed, purpose).

``md5`` is shared by Spark and DuckDB, so samples and splits can be checked row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _key(*parts: Column | str | int) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def hash_order(key: Column, seed: int) -> Column:
    """Sort key of a seeded shuffle: ``md5(key || ':' || seed)``; ties are broken by ``key``."""
    return F.md5(_key(key, seed))


def uniform(*parts: Column | str | int) -> Column:
    """A value in [0, 1) from the first 32 bits of ``md5(parts joined by ':')``."""
    h = F.md5(_key(*parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def uniform_int(low: Column | int, high: Column | int, *parts: Column | str | int) -> Column:
    """Integer uniform in [low, high] (both ends included)."""
    lo = low if isinstance(low, Column) else F.lit(low)
    hi = high if isinstance(high, Column) else F.lit(high)
    return (lo + F.floor(uniform(*parts) * (hi - lo + 1))).cast("int")


def list_md5(ids: Column) -> Column:
    """``md5(array_join(ids, ','))`` of an array of integers (NULLs left out, NULL for a NULL array), a whole Arrow
    batch at a time. The function refers to nothing outside itself."""
    def run(lists):
        import hashlib

        import pyarrow as pa
        import pyarrow.compute as pc

        if lists.flatten().null_count:
            joined = [None if v is None else ",".join(str(x) for x in v if x is not None) for v in lists.to_pylist()]
        else:
            joined = pc.binary_join(lists.cast(pa.list_(pa.string())), ",").to_pylist()
        return pa.array([None if t is None else hashlib.md5(t.encode()).hexdigest() for t in joined], pa.string())
    return F.arrow_udf(run, "string")(ids)
