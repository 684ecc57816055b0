"""Local map projection, coordinate gates and a least-squares affine fit."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRES_PER_DEGREE = 111_320.0
#: Gates of a fit: controls, root mean square and largest residual in metres.
LEAST_CONTROLS, MOST_RMSE, MOST_RESIDUAL = 4, 100.0, 150.0


def east_north(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Metres east and north of an origin."""
    return F.struct(((lon - lon0) * METRES_PER_DEGREE * F.cos(F.radians(lat0))).alias("east"), ((lat - lat0) * METRES_PER_DEGREE).alias("north"))


def near_point(lat: Column, lon: Column, lat0: float, lon0: float, degrees: float = 0.002) -> Column:
    return (F.abs(lat - lat0) < degrees) & (F.abs(lon - lon0) < degrees)


def location_score(*agreements: Column) -> Column:
    """How many facts agree; null doesn't."""
    total = F.lit(0)
    for a in agreements:
        total = total + F.coalesce(a, F.lit(False)).cast("int")
    return total


def printed_coordinates(text: Column) -> Column:
    """Latitude and longitude that are printed with labels and four decimals or more, inside their ranges."""
    find = lambda name: F.regexp_extract(text, rf"(?i){name}\w*\s*[:=]?\s*(-?\d{{1,3}}\.\d{{4,}})", 1).try_cast("double")
    lat, lon = find("lat"), find("lon")
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), F.struct(lat.alias("lat"), lon.alias("lon")))


FIT_SCHEMA = "a double, b double, c double, d double, e double, f double, controls int, rmse double, worst double, accepted boolean"


def affine_fit(controls: DataFrame, key: str) -> DataFrame:
    """Per key, the affine map from (x, y) to (east, north) by least squares over all controls, and whether it passes the gates.

    This is plain least squares, not a robust estimator: one wrong control
    fails the gates and isn't left out. Fewer than LEAST_CONTROLS controls, or
    controls on one line, are not accepted.
    """
    key_type = controls.schema[key].dataType.simpleString()

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna()
        n = len(rows)
        base = {key: rows[key].iloc[0] if n else None, "controls": n, "accepted": False}
        m = np.column_stack([rows["x"], rows["y"], np.ones(n)]) if n else np.zeros((0, 3))
        if n < LEAST_CONTROLS or np.linalg.matrix_rank(m) < 3:
            return pd.DataFrame([base | dict.fromkeys(["a", "b", "c", "d", "e", "f", "rmse", "worst"])]) if n else pd.DataFrame(columns=[key, "a", "b", "c", "d", "e", "f", "controls", "rmse", "worst", "accepted"])
        want = rows[["east", "north"]].to_numpy()
        w, *_ = np.linalg.lstsq(m, want, rcond=None)
        off = np.hypot(*(m @ w - want).T)
        rmse, worst = float(np.sqrt((off**2).mean())), float(off.max())
        (a, d), (b, e), (c, f) = w.tolist()
        return pd.DataFrame([base | {"a": a, "b": b, "c": c, "d": d, "e": e, "f": f, "rmse": rmse, "worst": worst, "accepted": rmse <= MOST_RMSE and worst <= MOST_RESIDUAL}])

    out = controls.select(key, "x", "y", "east", "north").groupBy(key).applyInPandas(lambda r: fit(r)[[key, "a", "b", "c", "d", "e", "f", "controls", "rmse", "worst", "accepted"]], f"{key} {key_type}, {FIT_SCHEMA}")
    return out
