"""Well-known binary polygons as rings and back; layers of vector files are kept as parquet with such a column."""
from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType

RING = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))


def _rings(data: bytes, at: int) -> tuple[list[list[tuple[float, float]]], int]:
    """(outer rings of a Polygon or MultiPolygon that starts at `at`, where it ends); other coordinates than x and y are skipped."""
    order = "<" if data[at] == 1 else ">"
    kind = struct.unpack_from(order + "I", data, at + 1)[0]
    extra = (kind >> 31) + (kind >> 30 & 1)  # flags of z and m; the one at 29 says that an id follows
    base = kind & 0xFFFF
    dims = 2 + extra + (base // 1000 in (1, 2)) + 2 * (base // 1000 == 3)
    at += 5 + 4 * (kind >> 29 & 1)
    n = struct.unpack_from(order + "I", data, at)[0]
    at += 4
    out = []
    for i in range(n):
        if base % 1000 == 3:
            m = struct.unpack_from(order + "I", data, at)[0]
            values = struct.unpack_from(f"{order}{m * dims}d", data, at + 4)
            at += 4 + 8 * m * dims
            if i == 0:  # holes follow the outer ring
                out.append([(values[j], values[j + 1]) for j in range(0, m * dims, dims)])
        else:
            more, at = _rings(data, at)
            out += more
    return out, at


@F.pandas_udf(ArrayType(RING))
def wkb_rings(c: pd.Series) -> pd.Series:
    """Outer rings of each part; null for null, none for what is not a polygon."""

    def one(b):
        if b is None:
            return None
        kind = struct.unpack_from("<I" if b[0] == 1 else ">I", b, 1)[0] & 0xFFFF
        return [[{"x": x, "y": y} for x, y in r] for r in _rings(bytes(b), 0)[0]] if kind % 1000 in (3, 6) else []

    return pd.Series([one(b) for b in c], dtype=object)


@F.pandas_udf(BinaryType())
def ring_wkb(c: pd.Series) -> pd.Series:
    """A closed ring as a Polygon."""
    return pd.Series([None if r is None else struct.pack("<BIII", 1, 3, 1, len(r)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in r) for r in c], dtype=object)
