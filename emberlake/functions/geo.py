"""Spatial cell key: the geohash string of a point, as column arithmetic.

A geohash of precision p has 5p bits, longitude and latitude bits
interleaved starting with longitude.  Each coordinate's bits are the binary
digits of its grid index, ``floor((v - min) * 2^bits / span)``; a value on
a cell edge falls into the upper cell.  Building the index with ``floor``
and reading bits with shifts keeps the whole key inside codegen: no UDF,
no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _grid_index(v: Column, lo: float, span: float, bits: int) -> Column:
    cells = 1 << bits
    idx = F.floor((v - F.lit(lo)) * F.lit(float(cells)) / F.lit(span)).cast("int")
    return F.least(F.greatest(idx, F.lit(0)), F.lit(cells - 1))


def bit_layout(precision: int) -> list[tuple[str, int]]:
    """For each of the 5p bits, most significant first: (axis, bit index)."""
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    layout = []
    for k in range(nbits):
        if k % 2 == 0:
            layout.append(("lon", lon_bits - 1 - k // 2))
        else:
            layout.append(("lat", lat_bits - 1 - k // 2))
    return layout


def geo_cell(latitude: Column | str, longitude: Column | str, precision: int = 3) -> Column:
    """Geohash cell of (latitude, longitude); NULL for missing or out-of-range points."""
    lat = F.col(latitude) if isinstance(latitude, str) else latitude
    lon = F.col(longitude) if isinstance(longitude, str) else longitude
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    x = _grid_index(lon, -180.0, 360.0, lon_bits)
    y = _grid_index(lat, -90.0, 180.0, lat_bits)
    layout = bit_layout(precision)
    chars = []
    for c in range(precision):
        idx = F.lit(0)
        for j in range(5):
            axis, b = layout[5 * c + j]
            src = x if axis == "lon" else y
            idx = idx + F.shiftright(src, b).bitwiseAND(1) * F.lit(1 << (4 - j))
        chars.append(F.substr(F.lit(GEOHASH_ALPHABET), idx + 1, F.lit(1)))
    valid = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.when(valid, F.concat(*chars))


def with_geo_cell(df: DataFrame, precision: int = 3, latitude: str = "latitude",
                  longitude: str = "longitude", out: str = "geo_cell") -> DataFrame:
    return df.withColumn(out, geo_cell(latitude, longitude, precision))
