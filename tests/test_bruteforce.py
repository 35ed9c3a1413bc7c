"""Operators against brute-force Python on small fixtures."""

import hashlib
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terracheck.operators.sampling import with_hash_rank
from terracheck.operators.validate import validate_records


def test_exact_k_equals_python_md5_sort(spark):
    ids = list(range(0, 3000, 3))
    df = spark.createDataFrame(pd.DataFrame({"row_id": ids})).repartition(5)
    for k, seed, step in ((1, 7, "a"), (50, 99, "ocean"), (999, 1, "x"), (2000, 3, "y")):
        got = {r.row_id: r._rank for r in with_hash_rank(df, k, seed, step).collect() if r._rank is not None}
        order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}|{step}|{i}".encode()).hexdigest(), i))
        want = {i: n + 1 for n, i in enumerate(order[:k])}
        assert got == want


# --- row rules: an independent plain-Python evaluator --------------------------------------
def _num_rule(field, v, lo, hi):
    if v is None:
        return f"{field}: Input should be a valid number"
    if math.isnan(v) or v > hi:
        return f"{field}: Input should be less than or equal to {hi}"
    if v < lo:
        return f"{field}: Input should be greater than or equal to {lo}"
    return None


def expected_errors(r):
    out = []
    if r["gppd_idnr"] is None:
        out.append("gppd_idnr: Input should be a valid string")
    elif r["gppd_idnr"].strip() == "":
        out.append("gppd_idnr: Value error, gppd_idnr must not be blank.")
    if r["name"] is None:
        out.append("name: Input should be a valid string")
    cap = r["capacity_mw"]
    if cap is not None and not math.isnan(cap) and cap < 0:
        out.append("capacity_mw: Input should be greater than or equal to 0")
    for f, lo, hi in (("latitude", -90, 90), ("longitude", -180, 180)):
        m = _num_rule(f, r[f], lo, hi)
        if m:
            out.append(m)
    c = r["country"]
    if c is None:
        out.append("country: Input should be a valid string")
    elif len(c) < 3:
        out.append("country: String should have at least 3 characters")
    elif len(c) > 3:
        out.append("country: String should have at most 3 characters")
    if r["primary_fuel"] is None:
        out.append("primary_fuel: Input should be a valid string")
    y = r["commissioning_year"]
    if y is None or math.isnan(y) or math.isinf(y):
        out.append("commissioning_year: Input should be a finite number")
    elif y != math.floor(y):
        out.append("commissioning_year: Input should be a valid integer, got a number with a fractional part")
    elif y < 1900:
        out.append("commissioning_year: Input should be greater than or equal to 1900")
    elif y > 2100:
        out.append("commissioning_year: Input should be less than or equal to 2100")
    return ", ".join(out)


floats = st.one_of(
    st.none(),
    st.sampled_from([float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 90.0, -90.0, 180.0, -180.0, 1900.0, 2100.0, 2005.5, 1e20]),
    st.floats(min_value=-400, max_value=2300, allow_nan=False),
)
texts = st.one_of(
    st.none(),
    st.sampled_from(["", "   ", "\t", "\u00a0", "\u2003 ", "USA", " us", "usa", "USAA", "US", "WRI1"]),
    st.text(alphabet=st.characters(blacklist_categories=("Cc", "Cs")), max_size=5),
)
record = st.fixed_dictionaries(
    {"gppd_idnr": texts, "name": texts, "capacity_mw": floats, "latitude": floats, "longitude": floats,
     "country": texts, "primary_fuel": texts, "commissioning_year": floats}
)

SCHEMA = (
    "row_id long, gppd_idnr string, name string, capacity_mw double, latitude double, longitude double, "
    "country string, primary_fuel string, commissioning_year double"
)
COLS = ["gppd_idnr", "name", "capacity_mw", "latitude", "longitude", "country", "primary_fuel", "commissioning_year"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=60))
def test_row_rules_equal_python_evaluator(spark, records):
    rows = [(i, *[r[c] for c in COLS]) for i, r in enumerate(records)]
    got = {r.row_id: r.pydantic_errors for r in validate_records(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, r in enumerate(records):
        assert got[i] == expected_errors(r), (r, got[i])


# --- polygons: an independent plain-Python even-odd + segment distance --------------------------
RINGS = {
    ("AAA", 0): [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]],
    ("BBB", 0): [[(20, 0), (26, 0), (26, 6), (23, 3), (20, 6)]],  # concave
    ("BBB", 1): [[(30, 0), (32, 0), (32, 2), (30, 2)]],
}


def _edges_of(iso):
    for (code, _), rings in RINGS.items():
        if code != iso:
            continue
        for ring in rings:
            for i, (x1, y1) in enumerate(ring):
                x2, y2 = ring[(i + 1) % len(ring)]
                yield x1, y1, x2, y2


def _py_inside(edges, px, py):
    c = 0
    for x1, y1, x2, y2 in edges:
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            c += 1
    return c % 2 == 1


def _py_dist(edges, px, py):
    best = math.inf
    for x1, y1, x2, y2 in edges:
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(px - (x1 + t * dx), py - (y1 + t * dy)))
    return best


def test_point_in_country_and_land_equal_python(spark):
    import random

    from terracheck.operators import geo
    from terracheck.sources.polygons import vertices_to_edges

    verts = [(c, p, r, i, float(x), float(y)) for (c, p), rings in RINGS.items() for r, ring in enumerate(rings)
             for i, (x, y) in enumerate(ring)]
    edges = vertices_to_edges(spark.createDataFrame(verts, "iso_a3 string, part int, ring int, seq int, x double, y double"))
    rnd = random.Random(11)
    pts = [(i, rnd.choice(["AAA", "BBB", "ZZZ"]), round(rnd.uniform(-2, 12), 3), round(rnd.uniform(-2, 34), 3))
           for i in range(600)]
    df = spark.createDataFrame(pts, "row_id long, country string, latitude double, longitude double")
    want = {}
    for i, iso, lat, lon in pts:
        e = list(_edges_of(iso))
        want[i] = True if not e else (_py_inside(e, lon, lat) or _py_dist(e, lon, lat) < 0.5)
    for method, cell in (("arrays", 5.0), ("cells", 5.0), ("cells", 0.7), ("cells", 2.3)):
        got = {r.row_id: r.in_country for r in geo.point_in_country(df, edges, method=method, cell_deg=cell).collect()}
        assert got == want, (method, cell)
    land_want = {}
    for i, _, lat, lon in pts:
        land_want[i] = any(_py_inside([e for r in RINGS[k] for e in _ring_edges(r)], lon, lat) for k in RINGS)
    for cell in (5.0, 1.1):
        got = {r.row_id: r.on_land for r in geo.on_land(df, edges, cell_deg=cell).collect()}
        assert got == land_want, cell


def _ring_edges(ring):
    for i, (x1, y1) in enumerate(ring):
        x2, y2 = ring[(i + 1) % len(ring)]
        yield x1, y1, x2, y2


# --- expectation suite: pandas computation, Python formatting ---------------------------------
def _pandas_suite(pdf):
    total = len(pdf)

    def not_null(col, thr, prefix=""):
        nulls = int(pdf[col].isna().sum())
        compl = (total - nulls) / total if total else 0.0
        detail = f"{nulls:,} / {total:,} values are null ({100 * (1 - compl):.1f}% missing)."
        return compl >= thr, round(compl, 4), prefix + detail

    def between(col, lo, hi):
        sub = pdf[col].dropna()
        n_out = int(((sub < lo) | (sub > hi)).sum())
        obs = f"min={sub.min():.2f}, max={sub.max():.2f}"
        detail = f"{n_out:,} values outside [{lo}, {hi}]." if n_out else f"All {len(sub):,} values within range."
        return n_out == 0, obs, detail

    ids = pdf["gppd_idnr"]
    dupe_mask = ids.duplicated(keep=False)
    n_dupes = int(dupe_mask.sum())
    top = ids[dupe_mask].dropna().value_counts()
    top = sorted(top.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    sample = "{" + ", ".join(f"'{k}': {v}" for k, v in top) + "}" if top else None
    udetail = f"{n_dupes:,} duplicate rows across {total - ids.nunique():,} non-unique values." + (
        f" Sample duplicates: {sample}" if sample else "")
    return {
        1: not_null("capacity_mw", 1.0),
        2: not_null("commissioning_year", 0.95, "Required ≥ 95% complete. "),
        3: (1 <= total <= 10_000_000, None, f"Dataset contains {total:,} rows."),
        4: (n_dupes == 0, round(1 - n_dupes / total, 4) if total else 1.0, udetail),
        5: between("latitude", -90, 90),
        6: between("longitude", -180, 180),
        7: between("capacity_mw", 0, 25_000),
        8: between("commissioning_year", 1900, 2100),
    }


def test_expectation_suite_equals_pandas(spark):
    import random

    from terracheck.operators.expectations import run_expectation_suite

    rnd = random.Random(5)
    for trial in range(3):
        n = rnd.randint(1, 400)
        ids = [rnd.choice([None] + [f"ID{rnd.randint(0, n)}" for _ in range(3)]) for _ in range(n)]
        rows = [
            (i, ids[i],
             rnd.choice([None, round(rnd.uniform(-100, 30000), 4), 10.125]),
             rnd.choice([round(rnd.uniform(-100, 100), 3), 95.125]),
             round(rnd.uniform(-200, 200), 3),
             rnd.choice([None, float(rnd.randint(1850, 2200))]))
            for i in range(n)
        ]
        pdf = pd.DataFrame(rows, columns=["row_id", "gppd_idnr", "capacity_mw", "latitude", "longitude", "commissioning_year"])
        df = spark.createDataFrame(rows, "row_id long, gppd_idnr string, capacity_mw double, latitude double, longitude double, "
                                         "commissioning_year double")
        got = {r.check_order: r for r in run_expectation_suite(df).collect()}
        for order, (success, observed, detail) in _pandas_suite(pdf).items():
            assert got[order].success == success, (trial, order)
            assert got[order].detail == detail, (trial, order, got[order].detail, detail)
            if isinstance(observed, str):
                assert got[order].observed == observed, (trial, order)
            elif observed is not None:
                assert got[order].observed_value == observed, (trial, order)
