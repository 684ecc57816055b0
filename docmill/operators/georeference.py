"""Places of map pins from landmarks that are known on the ground, also where some landmarks are wrong."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import LEAST_CONTROLS, METRES_PER_DEGREE, MOST_RESIDUAL, MOST_RMSE

#: Metres within which a landmark agrees with a map.
AGREES = 75.0
#: Times that a map's scale in one direction may be its scale in another.
STRETCH = 10.0
#: Triples that are tried: all of them up to so many, else so many drawn with a fixed seed.
TRIPLES = 1000
SCHEMA = "status string, reason string, controls int, inliers int, rmse double, worst double, lat double, lon double"
# Why a pin has no place.
NO_PIN, FEW, APART, OUTSIDE, COARSE = "red_pin_not_detected", "fewer_than_four_landmarks", "landmarks_not_geometrically_consistent", "pin_outside_landmark_coverage", "residual_exceeds_accuracy_gate"


@lru_cache(maxsize=4096)
def _triples(n: int) -> np.ndarray:
    if n * (n - 1) * (n - 2) // 6 <= TRIPLES:
        return np.array(list(combinations(range(n), 3)))
    r = np.random.default_rng(n)
    return np.sort(np.array([r.choice(n, 3, replace=False) for _ in range(TRIPLES)]), axis=1)


def agreeing(pixels: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Which controls agree with the affine map, through three of them, that most agree with; of equal counts the smallest sum of squares within AGREES.

    Maps that are stretched more than STRETCH are left out: through two right controls and a wrong one there is
    a map that agrees with all others near the line through the two, and it pulls one direction out to where the wrong one says.
    Metres are those at the latitude of the three, so wrong controls don't change what right ones measure.
    """
    t = _triples(len(pixels))
    px, py = pixels.T
    # Two sides of each triangle, and the affine map that takes them from pixels to metres, by Cramer's rule.
    ax, ay, bx, by = (c[t[:, k]] - c[t[:, 0]] for k in (1, 2) for c in (px, py))
    det = ax * by - ay * bx
    fit = np.abs(det) > 1e-9  # three controls on a line fix no map
    t, ax, ay, bx, by, det = t[fit], ax[fit], ay[fit], bx[fit], by[fit], det[fit]
    maps = []
    for degrees, scale in ((lat, METRES_PER_DEGREE), (lon, METRES_PER_DEGREE * np.cos(np.radians(lat[t].mean(axis=1))))):
        a, b = (degrees[t[:, 1]] - degrees[t[:, 0]]) * scale, (degrees[t[:, 2]] - degrees[t[:, 0]]) * scale
        maps.append((degrees, np.broadcast_to(scale, len(t)), (by * a - ay * b) / det, (ax * b - bx * a) / det))
    (_, _, u, v), (_, _, w, z) = maps
    # The largest scale of a map over its smallest, and the inverse, add up to this share.
    even = u * u + v * v + w * w + z * z <= (STRETCH + 1 / STRETCH) * np.abs(u * z - v * w)
    if not even.any():
        return np.zeros(len(pixels), bool)
    first, squares = t[even, 0], 0.0
    for degrees, scale, u, v in maps:
        scale, u, v = scale[even], u[even], v[even]
        base = scale * degrees[first] - u * px[first] - v * py[first]
        squares = squares + (np.outer(u, px) + np.outer(v, py) + base[:, None] - np.outer(scale, degrees)) ** 2
    near = squares <= AGREES**2
    count, error = near.sum(axis=1), np.where(near, squares, 0).sum(axis=1)
    return near[np.lexsort((np.round(error, 6), -count))[0]]


def inside_hull(points: np.ndarray, pin: np.ndarray) -> bool:
    """Whether the pin lies in the convex hull of the points, its edge included: no line through the pin has all of them strictly on one side."""
    away = points - pin
    length = np.hypot(*away.T)
    if (length < 1e-9).any():
        return True
    turn = np.sort(np.arctan2(away[:, 1], away[:, 0]))
    gaps = np.diff(np.append(turn, turn[0] + 2 * np.pi))
    return bool(gaps.max() <= np.pi + 1e-9)


def _place(pixels: np.ndarray, lat: np.ndarray, lon: np.ndarray, pin: np.ndarray | None) -> dict:
    out: dict = {"controls": len(pixels), "status": "unverified"}
    if pin is None:
        return out | {"reason": NO_PIN}
    if len(pixels) < LEAST_CONTROLS:
        return out | {"reason": FEW}
    good = agreeing(pixels, lat, lon)
    if good.sum() < LEAST_CONTROLS:
        return out | {"reason": APART}
    if not inside_hull(pixels, pin):
        return out | {"reason": OUTSIDE}
    lat0, lon0 = lat[good].mean(), lon[good].mean()
    east = METRES_PER_DEGREE * np.cos(np.radians(lat0))
    metres = np.column_stack([(lon - lon0) * east, (lat - lat0) * METRES_PER_DEGREE])
    m = np.column_stack([pixels, np.ones(len(pixels))])
    fit = np.linalg.lstsq(m[good], metres[good], rcond=None)[0]
    off = np.linalg.norm(m[good] @ fit - metres[good], axis=1)
    rmse, worst = float(np.sqrt((off**2).mean())), float(off.max())
    out |= {"inliers": int(good.sum()), "rmse": round(rmse, 1), "worst": round(worst, 1)}
    if rmse > MOST_RMSE or worst > MOST_RESIDUAL:
        return out | {"reason": COARSE}
    x, y = np.append(pin, 1.0) @ fit
    return out | {"status": "verified", "lat": round(float(lat0 + y / METRES_PER_DEGREE), 6), "lon": round(float(lon0 + x / east), 6)}


def placed_pins(controls: DataFrame, pins: DataFrame, key: str) -> DataFrame:
    """Per key of either side: status (verified or unverified), reason, counts, errors in metres, and lat and lon where verified.

    controls has key, x, y (pixels), lat and lon; pins key, x and y. Rows with a null are
    left out; of several pins of one key the smallest counts; null keys are one
    of their own. A wrong control is left out if LEAST_CONTROLS others agree within AGREES
    metres on a map that isn't stretched more than STRETCH. A pin outside the hull of all controls isn't placed, since nothing
    measures the error there. A key's controls, the landmarks of one map, meet in one row.
    """
    kind = controls.schema[key].dataType.simpleString()

    def known(*names: str):
        values = [F.col(c).cast("double") for c in names]
        full = [v.isNotNull() & ~F.isnan(v) for v in values]
        return F.when(reduce(and_, full), F.array(*values))

    one = controls.select(key, known("x", "y", "lat", "lon").alias("control"), F.lit(None).cast("array<double>").alias("pin"))
    two = pins.select(key, F.lit(None).cast("array<double>").alias("control"), known("x", "y").alias("pin"))
    maps = one.unionByName(two).groupBy(key).agg(F.sort_array(F.collect_list("control")).alias("controls"), F.min("pin").alias("pin"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, pin in zip(batch.column("controls"), batch.column("pin")):
                c = own.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                out.append(_place(c[:, :2], c[:, 2], c[:, 3], pin.values.to_numpy(zero_copy_only=False) if pin.is_valid else None))
            facts = [pa.array([r.get(c) for r in out], t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *facts], names=[key, *columns])

    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [{"string": pa.string(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]] for c in SCHEMA.split(", ")]
    return maps.mapInArrow(place, f"`{key}` {kind}, {SCHEMA}")
