"""track_length beside its SQL: check it against a brute-force pandas /
scalar implementation on the sf0.001 tables (independent pairing and an
independent scalar inverse-Vincenty)."""

import json
import math

import pandas as pd

from dovetail.plans.geo import track_length
from tests.conftest import SF


def vincenty_scalar(lon1, lat1, lon2, lat2):
    a, b = 6378137.0, 6356752.314245
    f = (a - b) / a
    L = math.radians(lon2 - lon1)
    U1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    U2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(math.cos(U2) * sl, math.cos(U1) * math.sin(U2) - math.sin(U1) * math.cos(U2) * cl)
        if ss == 0:
            return 0.0
        cs = math.sin(U1) * math.sin(U2) + math.cos(U1) * math.cos(U2) * cl
        sig = math.atan2(ss, cs)
        sa = math.cos(U1) * math.cos(U2) * sl / ss
        c2a = 1 - sa * sa
        c2m = cs - 2 * math.sin(U1) * math.sin(U2) / c2a if c2a else 0.0
        C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        prev, lam = lam, L + (1 - C) * f * sa * (sig + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m)))
        if abs(lam - prev) < 1e-13:
            break
    u2 = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * ss * (c2m + B / 4 * (cs * (-1 + 2 * c2m * c2m) - B / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))
    return b * A * (sig - ds)


def test_track_length_matches_brute_force(spark):
    ev = pd.read_parquet(f"{SF}/events.parquet")
    ev = ev[(ev.event_type != "signup") & (ev.event_type != "error")].copy()
    k = ev.props.map(lambda p: json.loads(p)["k"])
    ev["lon"] = 116 + k / 100 + ev.value / 1000
    ev["lat"] = 39 + ev.value / 100
    ev["day"] = (ev.ts + pd.Timedelta(hours=8)).dt.strftime("%Y%m%d")
    ev["sec"] = (ev.ts + pd.Timedelta(hours=8)).dt.floor("s")
    expect = {}
    for (vid, day), g in ev.sort_values(["sec", "event_id"]).groupby(["user_id", "day"]):
        pts = list(zip(g.lon, g.lat))
        expect[(vid, day)] = (len(pts), sum(vincenty_scalar(*p, *q) for p, q in zip(pts, pts[1:])))
    got = {(r.vehicle_id, r.day): (r.n_fixes, r.track_m) for r in track_length(spark, SF).collect()}
    assert got.keys() == expect.keys()
    for key, (n, m) in expect.items():
        assert got[key][0] == n
        assert math.isclose(got[key][1], m, rel_tol=1e-6, abs_tol=1e-3), key
