"""Column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinetra.spec import TICKS_PER_SECOND, G


def magnitude(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def is_finite(c: Column) -> Column:
    """Not null, not NaN, not infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def g_to_si(c: Column) -> Column:
    return c * F.lit(G)


def degrees_to_si(c: Column) -> Column:
    return c * F.lit(math.pi / 180.0)


def ticks_to_ms(c: Column) -> Column:
    return c / F.lit(TICKS_PER_SECOND) * F.lit(1000.0)


def micros_to_ms(c: Column) -> Column:
    return c / F.lit(1000.0)


def seconds_to_ms(c: Column) -> Column:
    return c * F.lit(1000.0)


def timestamp_micros(c: Column) -> Column:
    """Microseconds since 1970 of a timestamp or an ISO text, read as it stands: without a zone, whatever the session's is.

    Unparsable text gives null.
    """
    wall = c.cast("string").try_cast("timestamp_ntz")
    day = F.unix_date(wall.cast("date")).cast("long") * 86_400
    clock = F.hour(wall) * 3600 + F.minute(wall) * 60
    return ((day + clock) * 1_000_000 + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("long"))


def low_byte(c: Column) -> Column:
    """The low byte of a status word."""
    return c.bitwiseAND(F.lit(0xFF))


def bin_index(t: Column, start: Column, n_bins: Column, width: float) -> Column:
    """Tumbling bin of a time; the last bin is closed on the right, times beyond the ends go to the end bins."""
    return F.least(F.greatest(F.floor((t - start) / F.lit(float(width))), F.lit(0)), n_bins - 1)


def first_frame_at(t: Column, start: Column, period: float) -> Column:
    """The least k with start + k * period >= t, exact although the division is rounded."""
    p = F.lit(float(period))
    k = F.ceil((t - start) / p)
    return F.when(start + (k - 1) * p >= t, k - 1).when(start + k * p < t, k + 1).otherwise(k)


def choose(mapping: dict, key: Column) -> Column:
    """Value of a constant map; unknown and null keys give null."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair)), key)


def segment_dir(src: Column, mode: Column, device: Column, number: Column) -> Column:
    """Relative place of a segment; ids have eight digits."""
    return F.format_string("sources/%s/segments/%s/%s/%08d.npz", src, mode, device, number)
