"""Portable seeded hash used wherever the original code draws random numbers.

``h(parts) = first 12 hex digits of md5(part1 ':' part2 ...)`` read as a 48-bit integer and
``u = h / 2**48`` in [0, 1).  The same value is computed by DuckDB with
``('0x' || substr(md5(concat_ws(':', ...)), 1, 12))::BIGINT`` so every seeded operator has an
exact SQL oracle, and the result never depends on partitioning or retries.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_48 = float(2 ** 48)


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def hash48(*parts) -> Column:
    """48-bit non-negative BIGINT hash of the ':'-joined string forms of ``parts``."""
    joined = F.concat_ws(":", *[_as_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 12), 16, 10).cast("bigint")


def unit(*parts) -> Column:
    """Uniform double in [0, 1) derived from :func:`hash48`."""
    return hash48(*parts) / F.lit(TWO_48)


def hash48_py(*parts) -> int:
    """Driver-side twin of :func:`hash48` for small parameter tables."""
    joined = ":".join(str(p) for p in parts)
    return int(hashlib.md5(joined.encode("utf-8")).hexdigest()[:12], 16)


def hash48_sql(*parts: str) -> str:
    """DuckDB expression of the same hash; ``parts`` are SQL expressions."""
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"('0x' || substr(md5(concat_ws(':', {inner})), 1, 12))::BIGINT"


def unit_sql(*parts: str) -> str:
    return f"({hash48_sql(*parts)} / {TWO_48!r})"
