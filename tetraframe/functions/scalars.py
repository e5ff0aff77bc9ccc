"""Scalar column functions: geometry, clipping, colours, units, file names."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(x: Column, digits: int = 6) -> Column:
    """Rounded, without a negative zero: what two engines agree on. The small shift keeps short fractions off the ties."""
    return F.round(x + F.lit(1.7e-9), digits) + F.lit(0.0)


def norm(*parts: Column) -> Column:
    """Euclidean length."""
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total)


def spherical(dx: Column, dy: Column, dz: Column, radius: Column) -> dict[str, Column]:
    """Distance, depth below a sphere's surface, depth over radius, polar angle from -Y and azimuth from +X, in degrees."""
    r = norm(dx, dy, dz)
    cos = F.least(F.greatest(-dy / F.greatest(r, F.lit(1e-10)), F.lit(-1.0)), F.lit(1.0))
    return {"radial_dist": r, "spherical_depth": radius - r, "spherical_depth_norm": (radius - r) / radius, "theta_deg": F.degrees(F.acos(cos)), "phi_deg": F.degrees(F.atan2(dz, dx))}


def clip(x: Column, low: float, high: float) -> Column:
    """x held between two bounds."""
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def saturating_uint16(x: Column) -> Column:
    """Clipped to 0..65535 and truncated."""
    return clip(x, 0, 65535).cast("int")


def minmax_stretch(x: Column, low: Column, high: Column, to_low: float, to_high: float) -> Column:
    """Linear map of [low, high] to [to_low, to_high]."""
    return (x - low) * (to_high - to_low) / (high - low) + to_low


def percentile_window(x: Column, low: Column, high: Column) -> Column:
    """Clipped at a high percentile, less a low one, not below 0."""
    return F.greatest(F.least(x, high) - low, F.lit(0.0))


def hash_color(label: Column) -> Column:
    """A colour from 5 to 255 by multiplicative hashing; wide decimals keep it free of overflow."""
    return (F.pmod(label.cast("decimal(20,0)") * F.lit(2654435761).cast("decimal(10,0)"), F.lit(251).cast("decimal(3,0)")) + 5).cast("int")


def lut_value(x: Column, low: Column, high: Column) -> Column:
    """Scaled from low..high to 5..255, truncated; null is 20. A flat range gives 5."""
    scaled = (x - low) / F.greatest(high - low, F.lit(1e-10)) * 250 + 5
    return F.when(x.isNull(), F.lit(20)).otherwise(scaled).cast("int")


def lut_diverging(x: Column, most: Column) -> Column:
    """Scaled from -most..most to 5..255, truncated, beyond it held; null counts as 0. Without any value, most null, all are 128."""
    v = clip(F.coalesce(x, F.lit(0.0)) / F.greatest(most, F.lit(1e-6)), -1.0, 1.0)
    return F.when(most.isNull(), 128).otherwise(((v + 1) / 2 * 250 + 5).cast("int"))


def lut_flag(x: Column) -> Column:
    """240 for true, 20 for false or null."""
    return F.when(x, 240).otherwise(20)


def slider_bounds(x: Column) -> tuple[Column, Column]:
    """A speed slider's upper end and step: a tenth above the greatest speed (at least 1), up to a whole step of its size."""
    v = F.greatest(x, F.lit(1.0)) * 1.1
    top = F.when(v <= 5, F.ceil(v * 10) / 10).when(v <= 50, F.ceil(v).cast("double")).otherwise(F.ceil(v / 10) * 10.0)
    return top, F.when(v <= 5, 0.1).when(v <= 50, 0.5).otherwise(1.0)


def channel_of(name: Column) -> Column:
    """Digits after "_Channel ", else 1."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(name, r"_Channel (\d+)", 1), F.lit("")), F.lit("999999")).cast("int"), F.lit(1))


def timepoint_name(t: Column) -> Column:
    """t and four digits."""
    return F.format_string("t%04d", t)


def sanitize_path(path: Column) -> Column:
    """Without backslashes and trailing slashes."""
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("")), "/+$", "")


def micrometres(x: Column, unit: Column) -> Column:
    """A length in micrometres from nm, um, mm or pm."""
    return F.when(unit == "nm", x * 1e-3).when(unit == "mm", x * 1e3).when(unit == "pm", x * 1e-6).otherwise(x)


def resolution_to_micrometres(per_unit: Column, unit: Column) -> Column:
    """Micrometres a pixel from pixels per inch or centimetre; null unless positive."""
    return F.when(per_unit > 0, F.when(unit == "inch", F.lit(25400.0)).otherwise(F.lit(10000.0)) / per_unit)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where that is not defined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def scaled_voxel(size: Column, factor: Column) -> Column:
    """Voxel size after scaling the grid by a factor."""
    return size / factor


def frame_to_index(frame: Column, first: int, n: int) -> Column:
    """Index of a frame, held inside 0..n-1."""
    return clip(frame - first, 0, n - 1).cast("int")


def sane_voxel(v: Column, canonical: float) -> Column:
    """v if it is a plausible size, else the canonical one."""
    return F.when((v > 0.05) & (v < 100), v).otherwise(F.lit(canonical))


def section_radius(radius: float, distance: Column) -> Column:
    """Radius of the circle that a plane at a distance cuts from a sphere; null if it misses it."""
    return F.when(F.abs(distance) < radius, F.sqrt(F.lit(radius * radius) - distance * distance))


def section_point(radius: Column, k: Column, n: int = 200) -> tuple[Column, Column]:
    """Point k of n on a circle, both ends included."""
    angle = k * (2 * math.pi / (n - 1))
    return radius * F.cos(angle), radius * F.sin(angle)
