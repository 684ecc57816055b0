import random

import numpy as np
import pytest

from docmill.operators import georeference as g

CONTROL, PIN = "map string, x double, y double, lat double, lon double", "map string, x double, y double"


def at(x, y, lat=26.0, lon=75.0):
    return lat + 0.00002 * x - 0.00003 * y, lon + 0.00003 * x + 0.00001 * y


def controls(name, points, wrong=(), by=0.01):
    out = []
    for k, (x, y) in enumerate(points):
        lat, lon = at(x, y)
        out.append((name, float(x), float(y), lat + (by if k in wrong else 0), lon))
    return out


SQUARE = [(0, 0), (900, 20), (880, 700), (30, 650), (400, 300), (500, 90)]


def placed(spark, rows, pins):
    return {r.map: r for r in g.placed_pins(spark.createDataFrame(rows, CONTROL), spark.createDataFrame(pins, PIN), "map").collect()}


def test_rules(spark):
    rows = (
        controls("good", SQUARE) + controls("one wrong", SQUARE, [2]) + controls("two wrong", SQUARE, [0, 3], 0.05) + controls("outside", SQUARE) + controls("few", SQUARE[:3]) + controls("three wrong", SQUARE, [0], 0.1)
        + controls("apart", SQUARE[:1], [0], 0.2) + controls("apart", SQUARE[1:2], [0], 0.7) + controls("apart", SQUARE[2:5]) + controls("line", [(k, 2 * k) for k in range(6)]) + controls("no pin", SQUARE) + [("good", None, 1.0, 1.0, 1.0)] + controls("edge", SQUARE)
    )
    pins = [(m, 450.0, 300.0) for m in ("good", "one wrong", "two wrong", "few", "apart", "three wrong", "only pin")] + [("line", 3.0, 6.0), ("outside", 950.0, 800.0), ("no pin", None, 3.0), ("edge", 0.0, 0.0), ("good", 999.0, 1.0)]
    got = placed(spark, rows, pins)
    lat, lon = at(450, 300)
    for name, n in (("good", 6), ("one wrong", 5), ("two wrong", 4), ("three wrong", 5)):
        r = got[name]
        assert (r.status, r.reason, r.controls, r.inliers) == ("verified", None, 6, n) and r.lat == pytest.approx(lat, abs=2e-6) and r.lon == pytest.approx(lon, abs=2e-6) and r.rmse < 1
    why = {"few": g.FEW, "apart": g.APART, "line": g.APART, "outside": g.OUTSIDE, "no pin": g.NO_PIN, "only pin": g.FEW}
    assert {m: got[m].reason for m in why} == why and all(got[m].lat is None and got[m].status == "unverified" for m in why)
    assert got["edge"].status == "verified"


def test_wrong_control_beside_others_on_a_line(spark):
    line = [(907, 321), (907, 218), (907, 434)]
    rows = controls("three on a line", [*line, (862, 494), (981, 636)], [4], 53) + controls("one twice", [(891, 339), (891, 339), (235, 75), (178, 213)], [3], 59) + controls("no more", [*line, (981, 636)], [3], 53)
    got = placed(spark, rows, [("three on a line", 895.0, 366.0), ("one twice", 549.0, 241.0), ("no more", 925.0, 402.0)])
    r = got["three on a line"]
    assert (r.status, r.inliers) == ("verified", 4) and (r.lat, r.lon) == pytest.approx(at(895, 366), abs=2e-6)
    assert got["one twice"].reason == g.APART and got["no more"].reason == g.APART


def test_noise_and_large_sets(spark):
    r = random.Random(3)
    points = [(r.uniform(0, 1000), r.uniform(0, 800)) for _ in range(60)]
    rows = controls("many", points, range(0, 60, 5), 0.4)
    noisy = [(m, x, y, lat + r.gauss(0, 1e-5), lon) for m, x, y, lat, lon in rows]
    got = placed(spark, noisy, [("many", 500.0, 400.0)])["many"]
    assert got.status == "verified" and got.inliers == 48 and 0.3 < got.rmse < 3 and got.lat == pytest.approx(at(500, 400)[0], abs=2e-5)
    assert placed(spark, list(reversed(noisy)), [("many", 500.0, 400.0)])["many"] == got  # the order of rows changes nothing


def test_coarse_agreement_is_refused(monkeypatch):
    monkeypatch.setattr(g, "AGREES", 400.0)
    lat, lon = np.array([at(x, y) for x, y in SQUARE]).T
    lat[4] += 0.003
    assert g._place(np.array(SQUARE, float), lat, lon, np.array([450.0, 300.0]))["reason"] == g.COARSE


def test_hull_against_half_planes():
    r = np.random.default_rng(1)
    for _ in range(300):
        points, pin = r.integers(0, 8, (r.integers(3, 7), 2)).astype(float), r.integers(0, 8, 2).astype(float)
        # A pin is outside if some line separates it strictly: enough to try normals of all pairs and of all points.
        ends = np.vstack([points, pin])
        normals = [np.array([-d[1], d[0]]) for a in ends for b in ends if (d := b - a).any()] + [d for a in points if (d := a - pin).any()]
        turned = [np.array([n[0] + 1e-4 * s * n[1], n[1] - 1e-4 * s * n[0]]) for n in normals for s in (-1, 0, 1)]
        outside = any((points @ n > pin @ n + 1e-9).all() or (points @ n < pin @ n - 1e-9).all() for n in turned)
        assert g.inside_hull(points, pin) == (not outside), (points, pin)


def test_empty(spark):
    assert placed(spark, [], []) == {}
