"""Orientation, spherical coordinates, surfaces and sphere fits of point clouds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tetraframe.functions.quantiles import exact_quantiles
from tetraframe.functions.scalars import norm, spherical
from tetraframe.operators.filters import shuffle_key

AXES = ("x", "y", "z")
XYZ = [f"position_{a}" for a in AXES]


def rotation_matrix(u, v) -> np.ndarray:
    """The rotation that takes direction u to v; the identity if they agree, a half turn about X if they oppose."""
    u, v = (np.asarray(x, float) / np.linalg.norm(x) for x in (u, v))
    c = float(u @ v)
    if c > 1 - 1e-12:
        return np.eye(3)
    if c < -1 + 1e-12:
        return np.diag([1.0, -1.0, -1.0])
    w = np.cross(u, v)
    k = np.array([[0, -w[2], w[1]], [w[2], 0, -w[0]], [-w[1], w[0], 0]])
    return np.eye(3) + k + k @ k / (1 + c)


def orientation(center, pole, dorsal) -> tuple[np.ndarray, np.ndarray]:
    """(R1, R2): the pole to -Y, then the dorsal landmark's XZ part to +X."""
    center = np.asarray(center, float)
    r1 = rotation_matrix(np.asarray(pole, float) - center, [0, -1, 0])
    d = r1 @ (np.asarray(dorsal, float) - center)
    flat = np.array([d[0], 0, d[2]])
    return r1, np.eye(3) if np.linalg.norm(flat) < 1e-12 else rotation_matrix(flat, [1, 0, 0])


def oriented_affine(r: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """The 4x4 transform of ZYX coordinates for a rotation of XYZ, after an earlier one."""
    p = np.eye(3)[::-1]
    out = np.eye(4)
    out[:3, :3] = p @ r @ p
    return out if before is None else out @ before


def rotated(df: DataFrame, r: np.ndarray, center) -> DataFrame:
    """Positions about a centre, turned."""
    d = [F.col(c) - float(v) for c, v in zip(XYZ, center)]
    return df.withColumns({c: sum((d[k] * float(r[i, k]) for k in range(1, 3)), d[0] * float(r[i, 0])) for i, c in enumerate(XYZ)})


def mean_position(df: DataFrame) -> tuple[float, float, float]:
    """The centre of the cloud: one row to the driver."""
    row = df.agg(*(F.avg(c) for c in XYZ)).first()
    return tuple(float(v or 0.0) for v in row)


def orient(df: DataFrame, pole, dorsal) -> DataFrame:
    """The cloud centred and turned so that the pole is at -Y and dorsal at +X."""
    center = mean_position(df)
    r1, r2 = orientation(center, pole, dorsal)
    return rotated(df, r2 @ r1, center)


def spherical_coordinates(df: DataFrame, center, radius: float) -> DataFrame:
    """Add distance, depth, relative depth and the two angles about a sphere."""
    return df.withColumns(spherical(*(F.col(c) - float(v) for c, v in zip(XYZ, center)), F.lit(float(radius))))


def thin_axis(df: DataFrame) -> int:
    """The axis of smallest extent, the first of equals."""
    row = df.agg(*(F.max(c) - F.min(c) for c in XYZ)).first()
    return int(np.argmin([float(v or 0.0) for v in row]))


def extract_surface(df: DataFrame, quantile: float = 0.95, bins: int = 40, fewest: int = 3, axis: int | None = None) -> DataFrame:
    """(side, u, v, w): per cell of a grid across the thin axis the mean of the upper and of the lower points.

    Upper points are at or above the cell's quantile, lower ones at or below that of its complement.
    """
    w = thin_axis(df) if axis is None else axis
    u, v = (k for k in range(3) if k != w)
    p = df.select(F.col(XYZ[u]).alias("u"), F.col(XYZ[v]).alias("v"), F.col(XYZ[w]).alias("w"))
    e = p.agg(*(f(c).alias(f"{n}_{c}") for c in "uv" for n, f in (("lo", F.min), ("hi", F.max))))
    p = p.crossJoin(F.broadcast(e))  # one row
    cell = lambda c: F.when(F.col(f"hi_{c}") > F.col(f"lo_{c}"), F.least(F.floor((F.col(c) - F.col(f"lo_{c}")) / ((F.col(f"hi_{c}") - F.col(f"lo_{c}")) / bins)), F.lit(bins - 1))).otherwise(0).cast("int")
    p = p.select("u", "v", "w", cell("u").alias("i"), cell("v").alias("j"))
    cuts = p.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.percentile("w", F.lit([quantile, 1 - quantile])).alias("q")).where(F.col("n") >= fewest)
    rows = p.join(cuts, ["i", "j"])
    sides = F.array_compact(F.array(F.when(F.col("w") >= F.col("q")[0], "upper"), F.when(F.col("w") <= F.col("q")[1], "lower")))
    return rows.withColumn("side", F.explode(sides)).groupBy("side", "i", "j").agg(*(F.avg(c).alias(c) for c in "uvw")).select("side", "i", "j", "u", "v", "w")


def cap_guess(surface: DataFrame) -> DataFrame:
    """(side, radius, center_u, center_v, center_w, cap_height, cap_base_radius): a first guess of the sphere of which each side is a cap.

    The base radius is the largest lateral distance from the mean, the height the range along the thin axis, at least 1.
    """
    mid = surface.groupBy("side").agg(F.avg("u").alias("_u"), F.avg("v").alias("_v"))  # two rows
    far = norm(F.col("u") - F.col("_u"), F.col("v") - F.col("_v"))
    e = surface.join(F.broadcast(mid), "side").groupBy("side").agg(F.max("w").alias("hi"), F.min("w").alias("lo"), F.max(far).alias("a"), F.first("_u").alias("center_u"), F.first("_v").alias("center_v"))
    h = F.greatest(F.col("hi") - F.col("lo"), F.lit(1.0))
    r = (F.col("a") * F.col("a") + h * h) / (2 * h)
    return e.select("side", r.alias("radius"), "center_u", "center_v", F.when(F.col("side") == "upper", F.col("hi") - r).otherwise(F.col("lo") + r).alias("center_w"), h.alias("cap_height"), F.col("a").alias("cap_base_radius"))


def sphere_nls(points: np.ndarray, steps: int = 100) -> tuple[np.ndarray, float, float]:
    """(centre, radius, rmse) of the least-squares sphere: algebraic start, then damped Gauss-Newton on distances."""
    p = np.asarray(points, float)
    a = np.hstack([2 * p, np.ones((len(p), 1))])
    s, *_ = np.linalg.lstsq(a, (p**2).sum(1), rcond=None)
    x = np.append(s[:3], np.sqrt(max(s[3] + s[:3] @ s[:3], 1.0)))
    cost = lambda x: ((np.linalg.norm(p - x[:3], axis=1) - x[3]) ** 2).sum()
    best, damp = cost(x), 1e-3
    for _ in range(steps):
        d = np.linalg.norm(p - x[:3], axis=1)
        j = np.hstack([-(p - x[:3]) / np.maximum(d, 1e-12)[:, None], -np.ones((len(p), 1))])
        r = d - x[3]
        step = np.linalg.lstsq(np.vstack([j, np.sqrt(damp) * np.eye(4)]), np.append(-r, np.zeros(4)), rcond=None)[0]
        new = x + step
        new[3] = max(new[3], 1.0)
        if (c := cost(new)) < best:
            done = best - c < 1e-12 * max(best, 1e-12)
            x, best, damp = new, c, damp / 3
            if done:
                break
        else:
            damp *= 5
            if damp > 1e12:
                break
    return x[:3], float(x[3]), float(np.sqrt(best / len(p)))


def sphere_coverage(df: DataFrame, center, radius: float, n_theta: int = 12, n_phi: int = 24) -> DataFrame:
    """(coverage): share of direction bins that hold a point between half and one and a half radii; 0 with ten points or fewer."""
    rows = spherical_coordinates(df, center, radius).where((F.col("radial_dist") > 0.5 * radius) & (F.col("radial_dist") < 1.5 * radius))
    theta, phi = F.floor(F.col("theta_deg") / (180.0 / n_theta)), F.floor((F.col("phi_deg") + 180.0) / (360.0 / n_phi))
    return rows.agg(F.when(F.count(F.lit(1)) > 10, F.count_distinct(F.struct(theta.alias("a"), phi.alias("b"))) / float(n_theta * n_phi)).otherwise(0.0).alias("coverage"))


def nls_sphere(df: DataFrame, most: int = 100_000, seed: int = 42) -> DataFrame:
    """One row: centre, radius and rmse of the least-squares sphere through at most `most` points, a documented sample that the driver reads."""
    key = F.xxhash64(*XYZ, F.lit(seed))
    found = df.select(*XYZ).dropna().orderBy(key).limit(most).toArrow()
    center, radius, rmse = sphere_nls(np.stack([found[c].to_numpy() for c in XYZ], 1))
    return df.sparkSession.createDataFrame([(*map(float, center), radius, rmse)], "center_x double, center_y double, center_z double, radius double, rmse double")


def fit_sphere(df: DataFrame, quantile: float = 0.9125, most: int | None = None, seed: int = 42) -> DataFrame:
    """One row: centre, radius, rmse, surface_used, coverage of the better of the spheres through the upper and lower surface.

    The surface has at most 2 * 40 * 40 points; only they come to the driver, so all points may take part. most: a sample of as many
    points by shuffled id instead.
    """
    if most is not None:
        df = df.orderBy(shuffle_key(F.col("id"), seed), "id").limit(most)
    w = thin_axis(df)
    u, v = (k for k in range(3) if k != w)
    found = extract_surface(df, quantile, axis=w).collect()
    fits = []
    for side in ("upper", "lower"):
        p = np.zeros((sum(r["side"] == side for r in found), 3))
        for c, k in (("u", u), ("v", v), ("w", w)):
            p[:, k] = [r[c] for r in found if r["side"] == side]
        if len(p) >= 4:
            fits.append((*sphere_nls(p), side))
    if not fits:
        raise ValueError("too few surface points for a sphere")
    center, radius, rmse, side = min(fits, key=lambda x: x[2])
    row = sphere_coverage(df, center, radius)
    return row.select(*(F.lit(float(c)).alias(f"center_{a}") for a, c in zip(AXES, center)), F.lit(radius).alias("radius"), F.lit(rmse).alias("rmse"), F.lit(side).alias("surface_used"), "coverage")


def manual_sphere(df: DataFrame, center) -> DataFrame:
    """(radius, rmse) about a chosen centre: the median distance and the spread about it."""
    d = df.select(norm(*(F.col(c) - float(v) for c, v in zip(XYZ, center))).alias("d"))
    m = exact_quantiles(d, "d", [0.5]).select(F.col("q")[0].alias("radius"))
    return d.crossJoin(F.broadcast(m)).agg(F.first("radius").alias("radius"), F.sqrt(F.avg(F.pow(F.col("d") - F.col("radius"), 2))).alias("rmse"))


def cap_mesh(angles: DataFrame, center, radius: float, n_lat: int = 30, n_lon: int = 60, padding: float = 10.0) -> DataFrame:
    """(i, j, x, y, z) vertices of the part of the sphere that the points see. angles: theta_deg and phi_deg.

    Both angles run from the 2nd percentile less `padding` degrees to the 98th and as much more, ends included; the polar one stays
    within 0 and 180.
    """
    two = lambda c, n: exact_quantiles(angles, c, [0.02, 0.98]).select(F.col("q").alias(n))
    q = two("theta_deg", "t").crossJoin(two("phi_deg", "p"))  # one row each
    ends = q.select(F.greatest(F.col("t")[0] - padding, F.lit(0.0)).alias("t0"), F.least(F.col("t")[1] + padding, F.lit(180.0)).alias("t1"), (F.col("p")[0] - padding).alias("p0"), (F.col("p")[1] + padding).alias("p1"))
    grid = ends.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_lat - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n_lon - 1))))
    step = lambda n, k, lo, hi: F.radians(F.col(lo) + (F.col(hi) - F.col(lo)) * F.col(k) / float(n - 1))
    a, b = step(n_lat, "i", "t0", "t1"), step(n_lon, "j", "p0", "p1")
    cx, cy, cz = center
    return grid.select("i", "j", (cx + radius * F.sin(a) * F.cos(b)).alias("x"), (cy - radius * F.cos(a)).alias("y"), (cz + radius * F.sin(a) * F.sin(b)).alias("z"))


def cap_triangles(spark, n_lat: int = 30, n_lon: int = 60) -> DataFrame:
    """(a, b, c) vertex numbers i * n_lon + j of the mesh's triangles, two a cell; the mesh has open edges."""
    q = spark.range((n_lat - 1) * (n_lon - 1)).select(F.floor(F.col("id") / (n_lon - 1)).alias("i"), (F.col("id") % (n_lon - 1)).alias("j"))
    at = lambda i, j: i * n_lon + j
    i, j = F.col("i"), F.col("j")
    corner = lambda b, c: F.struct(at(i, j).alias("a"), b.alias("b"), c.alias("c"))
    tri = F.array(corner(at(i, j + 1), at(i + 1, j + 1)), corner(at(i + 1, j + 1), at(i + 1, j)))
    return q.select(F.explode(tri).alias("t")).select("t.*")


def color_values(df: DataFrame, column: str, mode: str = "minmax") -> DataFrame:
    """(id, value 0..1): by range, symmetric about zero between the 2nd and 98th percentile, capped at the 98th, or inward.

    "symmetric": the greater size of the two percentiles maps to the ends, null to the middle. "cap": from 0 to the 98th percentile,
    null stays null. "inward": sizes of negative values up to their 95th percentile, others and null 0.
    """
    c = F.col(column)
    if mode == "inward":
        c = F.when(F.col(column) < 0, -F.col(column))
    e = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).crossJoin(exact_quantiles(df, c, [0.02, 0.98, 0.95]).select("q"))  # one row each
    rows = df.select("id", c.alias("_c")).crossJoin(F.broadcast(e))  # one row
    held = lambda x, lo, hi: F.least(F.greatest(x, F.lit(lo)), F.lit(hi))
    if mode == "symmetric":
        most = F.greatest(F.abs(F.col("q")[0]), F.abs(F.col("q")[1]), F.lit(1e-6))
        value = (held(F.coalesce(F.col("_c") / most, F.lit(0.0)), -1.0, 1.0) + 1) / 2
    elif mode == "cap":
        value = held(F.col("_c") / F.greatest(F.col("q")[1], F.lit(1e-6)), 0.0, 1.0)
    elif mode == "inward":
        value = held(F.coalesce(F.col("_c"), F.lit(0.0)) / F.greatest(F.coalesce(F.col("q")[2], F.lit(1.0)), F.lit(1e-6)), 0.0, 1.0)
    else:
        value = (F.col("_c") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-10))
    return rows.select("id", F.when(F.col("_c").isNull() & F.lit(mode in ("minmax", "cap")), F.lit(None)).otherwise(value).alias("value"))


def ingression_rgba(flag: Column, inward: Column) -> list[Column]:
    """Colour of a point by inward speed (0..1): grey without a flag, from orange to pink with it; fixed values."""
    t = inward
    rgba = ((0.45, 0.85 + 0.15 * t), (0.45, 0.35 * (1 - F.pow(t, 0.8))), (0.45, 0.15 + 0.70 * F.pow(t, 0.6)), (0.06, 0.65 + 0.35 * t))
    return [F.when(flag, on).otherwise(F.lit(off)).alias(n) for n, (off, on) in zip("rgba", rgba)]


#: Colours of points with and without a flag, by mode; fixed values.
FLAG_RGBA = {"roi": ((1.0, 0.9, 0.0, 1.0), (0.5, 0.5, 0.5, 0.12)), "tracked": ((0.20, 0.85, 1.00, 1.00), (0.55, 0.55, 0.55, 0.18))}


def flag_rgba(flag: Column, mode: str) -> list[Column]:
    """Colour of a point by a flag, "roi" or "tracked"."""
    hi, lo = FLAG_RGBA[mode]
    return [F.when(flag, F.lit(a)).otherwise(F.lit(b)).alias(n) for n, a, b in zip("rgba", hi, lo)]
