"""Units, rules and co-location on small constructed inputs."""

import math
import random
from datetime import datetime

import numpy as np
import pytest

from cairn.operators import colocate as C
from cairn.operators import qc, units
from cairn.operators.ranking import exact_median, keep_first, keep_last, positions


def test_canonical_units(make_obs):
    obs = make_obs([
        dict(value=45.0, unit="cm"),
        dict(variable="volumetric_water_content", value=47.0, unit="Percent"),
        dict(variable="ground_temperature", value=270.15, unit="K"),
        dict(variable="volumetric_ice_content", value=0.3, unit="fraction"),
        dict(variable="thaw_event_label", value=3.0, unit="category_index"),
        dict(value=2.0, unit="furlong"),
        dict(variable="ground_temperature", value=270.15, unit="k"),
    ])
    got = [(round(r.value, 6), r.unit) for r in units.to_canonical(obs).orderBy("ord").collect()]
    assert got == [(0.45, "m"), (0.47, "1"), (-3.0, "degC"), (0.3, "1"), (3.0, "category_index"), (2.0, "furlong"), (270.15, "k")]
    assert [r.obs_id for r in units.unit_problems(units.to_canonical(obs)).orderBy("obs_id").collect()] == ["o5", "o6"]
    with pytest.raises(Exception, match="no unit conversion"):
        units.to_canonical(obs, strict=True).collect()


def test_convert_and_failure(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1.0, "m", "cm"), (1.0, "degC", "K"), (0.5, "1", "%"), (7.0, "celsius", "degC")], "v double, a string, b string")
    assert [r[0] for r in df.select(units.convert(F.col("v"), F.col("a"), F.col("b"))).collect()] == [100.0, 274.15, 50.0, 7.0]
    with pytest.raises(Exception, match="no unit conversion"):
        df.select(units.convert(F.col("v"), F.lit("ft"), F.lit("m"))).collect()


def test_value_range_nan_and_examples(make_obs):
    v = [0.5, float("nan"), -999.0, 12.0, 12.0, 13.0, 14.0, 15.0, 16.0]
    r = qc.value_range_report(make_obs([dict(value=x) for x in v])).collect()
    assert len(r) == 1 and r[0].n_bad == 7 and r[0].n_total == 9
    assert r[0].examples == [-999.0, 12.0, 13.0, 14.0, 15.0]


def test_depth_serves_and_rollup(spark, make_obs):
    obs = make_obs([
        dict(variable="soil_temperature", depth_m=None), dict(variable="soil_temperature", depth_m=-1.0),
        dict(variable="soil_temperature", depth_m=0.0), dict(variable="snow_depth"),
    ])
    serves = spark.createDataFrame([("soil_temperature",), ("ndvi",)], "variable string")
    found = {(r.check, r.variable) for r in qc.validate_observations(serves, obs).collect()}
    assert found == {
        ("serves_subset_emitted", "ndvi"), ("subsurface_depth_missing", "soil_temperature"),
        ("subsurface_depth_negative", "soil_temperature"),
    }
    counts = {r.check: r.n for r in qc.finding_counts(qc.validate_observations(serves, obs)).collect()}
    assert sum(counts.values()) == 3


def test_staged_folder(spark):
    files = spark.createDataFrame(
        [("a", "PROVENANCE.json"), ("a", "CITATION.cff"), ("a", "README.md"), ("a", "data/x.xml"), ("b", "PROVENANCE.json"), ("b", "x.csv")],
        "dataset_id string, relative_path string",
    )
    records = spark.createDataFrame(
        [("a", '{"title": "T", "citation": "T. http://x", "source_url": "http://x"}'), ("b", "{nope"), ("c", '{"title": "T", "citation": null}')],
        "dataset_id string, content string",
    )
    got = sorted((r.check, r.severity) for r in qc.validate_staged(files, records).collect())
    assert got == [
        ("citation_synthesized", "error"), ("provenance_unreadable", "error"), ("self_describing_missing", "error"),
        ("self_describing_missing", "error"), ("self_describing_no_native", "warning"),
    ]


@pytest.mark.parametrize("seed, middle", [(1, 1 << 20), (2, 1 << 20), (1, 1), (3, 5)])
def test_exact_median_against_sort(spark, monkeypatch, seed, middle):
    import statistics

    from cairn.operators import ranking

    monkeypatch.setattr(ranking, "_MIDDLE", middle)  # a small one narrows the middle in further rounds
    monkeypatch.setattr(ranking, "_SLICES", 7)

    rng = random.Random(seed)
    rows = []
    for g in "abc":
        n = rng.choice([1, 2, 101, 250])
        rows += [(g, rng.choice([rng.gauss(0, 1), rng.randint(-5, 5) * 1.0, -9999.0, 1e12, 0.0, -0.0, 1e-9])) for _ in range(n)]
    rows += [("d", float("nan")), ("d", 4.0), (None, 2.0), (None, 5.0), ("e", float("inf")), ("e", 1.0), ("e", float("-inf"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    want = {}
    for g, v in rows:
        if not math.isnan(v):
            want.setdefault(g, []).append(v)
    assert got == {g: statistics.median(vs) for g, vs in want.items()}


def test_median_shuffles_buckets_and_the_middle_only(spark):
    """100,000 distinct values: histogram rows and the middle bucket's values are all that is grouped."""
    from cairn.operators import ranking

    df = spark.range(100_000).selectExpr("id % 2 as k", "100 + id / 1000D as v")
    hist = ranking.histogram(df, ["k"], "v")
    rows = hist.collect()
    assert len(rows) < 200 and max(r["__c"] for r in rows) < 1600
    assert {r.k: r["median"] for r in exact_median(df, ["k"], "v").collect()} == {0: 149.999, 1: 150.0}
    plan = exact_median(df, ["k"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "__lo" in plan.split("Aggregate")[-1]  # values meet the middle's range below the grouping


def test_keep_and_positions(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 9, "q")], "k string, ord bigint, v string")
    assert sorted(r.v for r in keep_first(df, ["k"]).collect()) == ["q", "x"]
    assert sorted(r.v for r in keep_last(df, ["k"]).collect()) == ["q", "z"]
    big = spark.range(5000).selectExpr("id % 3 as k", "id * id as ord")
    got = positions(big, ["k"], "ord", "p")
    assert got.filter("p <> cast(sqrt(ord) as bigint) div 3 + 1").count() == 0


# --- co-location -----------------------------------------------------------------------


def site(src, lat, lon, value, depth=None, variable="active_layer_thickness"):
    return dict(source=src, latitude=float(lat), longitude=float(lon), value=value, depth_m=depth, variable=variable)


def test_colocation_example(make_obs):
    obs = make_obs([
        site("calm", 71.31, -156.6, 0.40), site("calm", 64.84, -163.7, 1.00), site("calm", 70.0, -150.0, 0.5),
        site("above", 71.312, -156.61, 0.41), site("above", 71.305, -156.59, 0.43), site("above", 64.85, -163.71, 0.51),
        site("above", 70.01, -150.01, 0.52), site("above", 60.0, -140.0, 9.0),
    ])
    r = C.consistency_report(obs).collect()[0]
    assert (r.check, r.n_colocated, r.n_disagreements, r.metric) == ("cross_source_consistency", 3, 1, "ratio")
    assert r.pair_labels == ["calm vs above"] and abs(r.median_metric - 1.04) < 0.02
    w = C.worst_sites(C.colocate(obs)).collect()
    assert len(w) == 1 and w[0].lat == 64.84 and w[0].metric == 0.51


@pytest.mark.parametrize("rows, check", [
    ([site("a", 65, -150, 1.0), site("b", 65.108, -150, 1.0)], "cross_source_no_overlap"),
    ([site("a", 65, -150, 0.0), site("b", 65, -150, 1.0)], "cross_source_metric_uncomputable"),
    ([site("a", 65, -150, 1.0, None), site("b", 65, -150, 1.0, 0.0)], "cross_source_consistency"),
    ([site("a", 65, -150, -1.0, 2.0, "ground_temperature"), site("b", 65, -150, -1.0, 50.0, "ground_temperature")], "cross_source_no_overlap"),
])
def test_colocation_outcomes(make_obs, rows, check):
    r = C.consistency_report(make_obs(rows)).collect()
    assert [x.check for x in r] == [check]


def test_colocation_single_source_and_anchor(make_obs):
    assert C.consistency_report(make_obs([site("a", 65, -150, 1.0)])).collect() == []
    rows = [site("big", 65, -150, 1.0), site("big", 65, -150, 2.0), site("small", 65, -150, 3.0)]
    pairs = C.colocate(make_obs(rows)).collect()
    assert [(p.anchor_source, p.n_near, p.other_mean) for p in pairs] == [("small", 2, 1.5)]


def brute_force(rows, tol):
    """Every pair of every pair of sources, one by one."""
    out = {}
    by = {}
    for i, r in enumerate(rows):
        by.setdefault((r["variable"], r["source"]), []).append((i, r))
    for (v, sa), a_rows in by.items():
        for (v2, sb), b_rows in by.items():
            if v != v2 or sa == sb or (len(a_rows), sa) > (len(b_rows), sb):
                continue
            for i, a in a_rows:
                dlon = tol.radius_km / (111.0 * max(math.cos(math.radians(a["latitude"])), 1e-6))
                near = []
                for _, b in b_rows:
                    if abs(b["latitude"] - a["latitude"]) > tol.dlat or abs(b["longitude"] - a["longitude"]) > dlon:
                        continue
                    p, q = math.radians(a["latitude"]), math.radians(b["latitude"])
                    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b["longitude"] - a["longitude"]) / 2) ** 2
                    far = 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h))) > tol.radius_km
                    if not far and abs((b["depth_m"] or 0.0) - (a["depth_m"] or 0.0)) <= tol.depth_m:
                        near.append(b["value"])
                if near:
                    out[f"o{i}", sb] = (len(near), round(sum(near) / len(near), 9))
    return out


@pytest.mark.parametrize("seed, lat0, radius, depth_tol, crowd", [(1, 65.0, 5.0, 1.0, 512), (1, 65.0, 5.0, 1.0, 1), (2, 88.5, 20.0, 0.0, 2), (3, -10.0, 300.0, 2.5, 3), (4, 0.0, 5.0, 1.0, 512)])
def test_colocation_against_brute_force(make_obs, monkeypatch, seed, lat0, radius, depth_tol, crowd):
    monkeypatch.setattr(C, "_CROWD", crowd)  # a small one cuts most cells, again and by hash
    rng = random.Random(seed)
    rows = []
    for _ in range(260):
        rows.append(site(
            rng.choice("abc"), round(lat0 + rng.uniform(-0.4, 0.4) * radius / 20, 3), round(rng.uniform(-179.9, 179.9) if seed == 2 else -150 + rng.uniform(-1, 1) * radius / 20, 3),
            rng.uniform(-5, 5), rng.choice([None, 0.0, 0.5, 1.0, 2.0, 10.0, -1.0]), rng.choice(["ground_temperature", "snow_depth"]),
        ))
    rows += [dict(rows[0]) for _ in range(140)]  # one hot place holds a third of the rows
    tol = C.Tolerance(radius_km=radius, depth_m=depth_tol)
    got = {(r.obs_id, r.other_source): (r.n_near, round(r.other_mean, 9)) for r in C.colocate(make_obs(rows), tol).collect()}
    want = brute_force(rows, tol)
    assert got.keys() == want.keys() and want
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


def test_one_crowded_cell(make_obs):
    """20,000 distinct places in one cell, most of them in a corner of it; far parts of the cell never meet."""
    rng = np.random.default_rng(7)
    tol = C.Tolerance()
    size = tol.cell_deg
    band = int(65.0 // size)
    lat = (band + np.concatenate([rng.uniform(0.01, 0.99, 8000), rng.uniform(0.9, 0.93, 12000)])) * size
    width = size / math.cos(math.radians((band + 1) * size))
    lon = (int(-150 // width) + np.concatenate([rng.uniform(0.01, 0.99, 8000), rng.uniform(0.1, 0.13, 12000)])) * width
    alat, alon = (band + rng.uniform(-0.45, 1.45, 150)) * size, (int(-150 // width) + rng.uniform(-0.45, 1.45, 150)) * width
    rows = [site("big", 65, -150, 1.0), site("big", 65, -150, 2.0), site("small", 65, -150, 3.0)]
    pairs = C.colocate(make_obs(rows)).collect()
    assert [(p.anchor_source, p.n_near, p.other_mean) for p in pairs] == [("small", 2, 1.5)]


def brute_force(rows, tol):
    """Every pair of every pair of sources, one by one."""
    out = {}
    by = {}
    for i, r in enumerate(rows):
        by.setdefault((r["variable"], r["source"]), []).append((i, r))
    for (v, sa), a_rows in by.items():
        for (v2, sb), b_rows in by.items():
            if v != v2 or sa == sb or (len(a_rows), sa) > (len(b_rows), sb):
                continue
            for i, a in a_rows:
                dlon = tol.radius_km / (111.0 * max(math.cos(math.radians(a["latitude"])), 1e-6))
                near = []
                for _, b in b_rows:
                    if abs(b["latitude"] - a["latitude"]) > tol.dlat or abs(b["longitude"] - a["longitude"]) > dlon:
                        continue
                    p, q = math.radians(a["latitude"]), math.radians(b["latitude"])
                    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b["longitude"] - a["longitude"]) / 2) ** 2
                    far = 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h))) > tol.radius_km
                    if not far and abs((b["depth_m"] or 0.0) - (a["depth_m"] or 0.0)) <= tol.depth_m:
                        near.append(b["value"])
                if near:
                    out[f"o{i}", sb] = (len(near), round(sum(near) / len(near), 9))
    return out


@pytest.mark.parametrize("seed, lat0, radius, depth_tol, crowd", [(1, 65.0, 5.0, 1.0, 512), (1, 65.0, 5.0, 1.0, 1), (2, 88.5, 20.0, 0.0, 2), (3, -10.0, 300.0, 2.5, 3), (4, 0.0, 5.0, 1.0, 512)])
def test_colocation_against_brute_force(make_obs, monkeypatch, seed, lat0, radius, depth_tol, crowd):
    monkeypatch.setattr(C, "_CROWD", crowd)  # a small one cuts most cells, again and by hash
    rng = random.Random(seed)
    rows = []
    for _ in range(260):
        rows.append(site(
            rng.choice("abc"), round(lat0 + rng.uniform(-0.4, 0.4) * radius / 20, 3), round(rng.uniform(-179.9, 179.9) if seed == 2 else -150 + rng.uniform(-1, 1) * radius / 20, 3),
            rng.uniform(-5, 5), rng.choice([None, 0.0, 0.5, 1.0, 2.0, 10.0, -1.0]), rng.choice(["ground_temperature", "snow_depth"]),
        ))
    rows += [dict(rows[0]) for _ in range(140)]  # one hot place holds a third of the rows
    tol = C.Tolerance(radius_km=radius, depth_m=depth_tol)
    got = {(r.obs_id, r.other_source): (r.n_near, round(r.other_mean, 9)) for r in C.colocate(make_obs(rows), tol).collect()}
    want = brute_force(rows, tol)
    assert got.keys() == want.keys() and want
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


def test_one_crowded_cell(make_obs):
    """20,000 distinct places in one cell, most of them in a corner of it; far parts of the cell never meet."""
    rng = np.random.default_rng(7)
    tol = C.Tolerance()
    band = int(65.0 // tol.dlat)
    lat = (band + np.concatenate([rng.uniform(0.01, 0.99, 8000), rng.uniform(0.9, 0.93, 12000)])) * tol.dlat
    width = tol.dlat / math.cos(math.radians((band + 1) * tol.dlat))
    lon = (int(-150 // width) + np.concatenate([rng.uniform(0.01, 0.99, 8000), rng.uniform(0.1, 0.13, 12000)])) * width
    alat, alon = (band + rng.uniform(-0.95, 1.95, 150)) * tol.dlat, (int(-150 // width) + rng.uniform(-0.95, 1.95, 150)) * width
    rows = [site("big", y, x, 1.0 + k % 7) for k, (y, x) in enumerate(zip(lat, lon))]
    obs = make_obs(rows + [site("few", y, x, 2.0) for y, x in zip(alat, alon)])
    got = {round(r.latitude, 12): (r.n_near, r.other_mean) for r in C.colocate(obs, tol).collect()}
    value = 1.0 + np.arange(20_000) % 7
    p, q = np.radians(alat)[:, None], np.radians(lat)[None, :]
    h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(lon[None, :] - alon[:, None]) / 2) ** 2
    near = 2 * 6371.0 * np.arcsin(np.sqrt(h)) <= tol.radius_km
    near &= (np.abs(lat[None, :] - alat[:, None]) <= tol.dlat) & (np.abs(lon[None, :] - alon[:, None]) <= tol.radius_km / (111.0 * np.cos(p)))
    want = {round(float(y), 12): (int(n.sum()), value[n].mean()) for y, n in zip(alat, near) if n.any()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    places = C._places(obs)
    places = places.join(C._with_roles(C._per_source(places)), ["variable", "source"])
    sides = C._sides(places, tol)
    met = lambda a, o, keys: a.select(*keys).join(o.select(*keys), keys).count()
    whole, cut = met(*sides, C._KEYS), met(*C._meeting_cells(*sides), [*C._KEYS, "shard"])
    box = int(((np.abs(lat[None, :] - alat[:, None]) <= tol.dlat) & (np.abs(lon[None, :] - alon[:, None]) <= tol.radius_km / (111.0 * np.cos(p)))).sum())
    assert whole > 1.5 * box and cut < 1.15 * box  # what meets is hardly more than what lies in the search box


def test_check_cross_source_findings(make_obs):
    obs = make_obs([site("a", 65, -150, 1.0), site("b", 65, -150, 2.0), site("b", 65, -150, 2.0)])
    f = C.check_cross_source(obs).collect()
    assert len(f) == 1 and f[0].severity == "warning" and '"n_disagreements":1' in f[0].detail


def test_assembly_request_tags(make_obs, tmp_path):
    from cairn.plans.assemble import AssemblyRequest, run

    obs = make_obs([
        dict(value=50.0, unit="cm", time_start=datetime(2016, 5, 1)), dict(latitude=10.0, time_start=datetime(2017, 1, 1)),
        dict(variable="snow_depth"), dict(value=1.0),
    ])
    req = AssemblyRequest(("active_layer_thickness", "nonsense"), (-160.0, 60.0, -140.0, 70.0), ("2016", "2016"), "parquet")
    a = run([obs], req, str(tmp_path))
    rows = a.observations.orderBy("ord").collect()
    assert [(r.in_bbox, r.in_time_range) for r in rows] == [(True, True), (False, False), (True, None)]
    assert a.observations.sparkSession.read.parquet(a.output_paths[0]).columns == [
        "obs_id", "source_id", "dataset_id", "variable", "value", "unit", "latitude", "longitude", "depth_m", "time_start", "time_end", "in_bbox"]
    assert {r.metric: r.n for r in a.summary.collect()}["n_observations"] == 3
    assert any("n=3" in r.line for r in a.notes.collect())


def test_failed_datasets_in_the_notes(make_obs, tmp_path):
    from cairn.plans.assemble import AssemblyRequest, run

    good = make_obs([dict(value=1.5), dict(value=None), dict(latitude=None)])
    bad = make_obs([dict(latitude=95.0), dict(longitude=None), dict(latitude=float("nan")), dict(value=None)])
    a = run({"good": good, "bad": bad, "none": bad.filter("false")}, AssemblyRequest(), str(tmp_path))
    lines = {r.line_ord: r.line for r in a.notes.filter("section = 4").collect()}
    assert lines == {
        "bad": "failed: bad: no usable row of 4 (1 without coordinates, 2 beyond the coordinate range, 1 without value)",
        "none": "failed: none: no rows"}
    assert a.observations.count() == 1


def test_general_numbers(spark):
    from cairn.functions.text import general

    rng = random.Random(3)
    values = [0.0, 1.0, -1.0, 9.996, 99.96, 999.6, 1234.5, 1e-4, 0.00009999, 1e300, -2.5e-7, 40.0, 100.0, float("nan"), float("inf")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 9) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(general(df["v"])).collect()]
    want = [f"{v:.3g}" for v in values]
    assert [(g, w) for g, w in zip(got, want) if g != w] == [("infinity", "inf")]


def test_numbers_round_like_printf(spark):
    """Ties of the binary value go to even; a value just off a tie goes to its side."""
    from pyspark.sql import functions as F

    from cairn.functions.text import fixed, general

    rng = random.Random(5)
    values = [466.5, 467.5, 1.005, 1.015, 9.995, 0.125, 0.135, -31.05, -31.049999999999983, 12450.0, 12350.0, 0.09995, 99.95, -0.0, -0.001, 2.675, 1e22]
    values += [rng.randint(0, 99999) / 10 ** rng.randint(0, 7) * rng.choice([-1, 1]) + 0.0 for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", general(F.col("v")), fixed(F.col("v") + F.lit(0.0), 2)).collect()
    assert [(v, g) for v, g, _ in rows if g != f"{v:.3g}"] == []
    assert [(v, f) for v, _, f in rows if f != f"{v + 0.0:.2f}"] == []


def test_depths_at_close_positions_do_not_multiply(make_obs, monkeypatch):
    """What meets is counted in columns, not in places; the means equal brute force, also where a column has several parts."""
    monkeypatch.setattr(C, "_LEVELS", 5)
    tol = C.Tolerance()
    rng = np.random.default_rng(8)
    few, big = ([(s, 65.0 + 1e-4 * p, float(d), float(v)) for p in range(n) for d, v in zip(rng.permutation(60)[:40] / 10, rng.uniform(1, 3, 40))] for s, n in (("few", 4), ("big", 8)))
    obs = make_obs([dict(source=s, latitude=y, depth_m=d, value=v) for s, y, d, v in few + big])
    places = C._places(obs)
    places = places.join(C._with_roles(C._per_source(places)), ["variable", "source"])
    a, o = C._meeting_cells(*C._sides(places, tol))
    met = a.alias("a").join(o.alias("o"), [*C._KEYS, "shard"]).count()
    assert met < len(few) * len(big) / 10
    got = {r.obs_id: (r.n_near, r.other_mean) for r in C.colocate(obs, tol).collect()}
    assert len(got) == len(few)
    for k, (_, _, d, _) in enumerate(few):
        near = [v for _, _, e, v in big if abs(e - d) <= 1.0]
        n, mean = got[f"o{k}"]
        assert n == len(near) and abs(mean - sum(near) / n) < 1e-9
