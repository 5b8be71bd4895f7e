"""Package index, catalog store, acquisition and discovery."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cairn.operators import catalog as K
from cairn.operators import discover as D
from cairn.operators import index as I
from cairn.plans.acquire import acquire, index_package, index_packages
from cairn.sources.normalise import Landing
from test_sources import CALM, land, put

NOW = datetime(2024, 1, 2)


def test_dictionary_package(spark, tmp_path):
    put(tmp_path / "BEO_soil_2012.csv", "a,b\n1,2\n")
    put(tmp_path / "BEO_soil_dd.csv", "Column_or_Row_Name,Unit,Definition,Data_Type\n"
        "soil_temperature_5cm,degC,Temp. Missing values = '-9999'. x,num\nsoil_temperature_15cm,degC,\"Temp, missing values = not_determined\",num\nsite,N/A,Name,text\n")
    put(tmp_path / "BEO_user_file.pdf", "%PDF")
    put(tmp_path / "README.md", "generated")
    put(tmp_path / ".hidden", "x")
    idx = index_package(spark, str(tmp_path), Landing("s", "sloan", access_timestamp=NOW))
    files = {r.relative_path: r for r in idx.files.collect()}
    assert {k: v.role for k, v in files.items()} == {"BEO_soil_2012.csv": "data", "BEO_soil_dd.csv": "dictionary", "BEO_user_file.pdf": "readme"}
    f = files["BEO_soil_2012.csv"]
    assert f.content_checksum == hashlib.sha256(b"a,b\n1,2\n").hexdigest() and f.bytes == 8
    assert f.file_id == hashlib.sha256(b"sloan|BEO_soil_2012.csv").hexdigest()[:16]
    assert f.missing_sentinel == "-9999, not_determined"
    v = {r.variable: r for r in idx.variables.collect()}
    assert v["soil_temperature"].raw_name == "soil_temperature_5cm, soil_temperature_15cm" and v["soil_temperature"].unit == "degC"
    assert v["soil_temperature"].parseable and not v["site"].parseable and v["site"].unit is None
    assert idx.standard.first().standard == "ess_dive_dd"


EML = """<?xml version="1.0"?><eml:eml xmlns:eml="eml://x"><dataset>
<dataTable><entityName>Sample.csv</entityName><attributeList>
<attribute><attributeName>EIC, %</attributeName><measurementScale><ratio><unit><standardUnit>percent</standardUnit></unit></ratio></measurementScale><missingValueCode><code>-99</code></missingValueCode></attribute>
<attribute><attributeName>GMC, %</attributeName><measurementScale><interval><unit><customUnit>pct</customUnit></unit></interval></measurementScale></attribute>
</attributeList></dataTable>
<dataTable><entityName>Other-Site.csv</entityName><attributeList><attribute><attributeName>VMC, %</attributeName></attribute></attributeList></dataTable>
<dataTable><entityName>gone.csv</entityName><attributeList><attribute><attributeName>NDVI</attributeName></attribute></attributeList></dataTable>
</dataset></eml:eml>"""


def test_bag_package(spark, tmp_path):
    put(tmp_path / "bagit.txt", "BagIt")
    put(tmp_path / "data/Sample.csv", "x\n")
    put(tmp_path / "data/Other_Site.csv", "y\n")
    put(tmp_path / "metadata/science-metadata.xml", EML)
    good = hashlib.md5(b"x\n").hexdigest().upper()
    put(tmp_path / "manifest-md5.txt", f"{good}  data/Sample.csv\n{'0' * 32}  data/Other_Site.csv\n\n")
    idx = index_package(spark, str(tmp_path), Landing("s", "kan", access_timestamp=NOW))
    assert idx.files.count() == 5 and idx.standard.first().standard == "dataone_bagit"
    assert [r.relative_path for r in idx.mismatches.collect()] == ["data/Other_Site.csv"]
    path = {r.file_id: r.relative_path for r in idx.files.collect()}
    got = {(r.variable, path[r.file_id]): r for r in idx.variables.collect()}
    assert set(got) == {("excess_ice_content", "data/Sample.csv"), ("GMC, %", "data/Sample.csv"), ("volumetric_water_content", "data/Other_Site.csv")}
    assert got["excess_ice_content", "data/Sample.csv"].unit == "percent" and got["GMC, %", "data/Sample.csv"].unit == "pct"
    assert {r.relative_path: r.missing_sentinel for r in idx.files.collect()}["data/Sample.csv"] == "-99"


def test_many_packages_in_one_job(spark, tmp_path):
    """Both standards, a bare folder and names with marks, below one root."""
    good = hashlib.md5(b"x\n").hexdigest()
    for k in range(3):
        put(tmp_path / f"bag{k}/bagit.txt", "BagIt")
        put(tmp_path / f"bag{k}/data/Sample.csv", "x\n")
        put(tmp_path / f"bag{k}/metadata/science-metadata.xml", EML)
        put(tmp_path / f"bag{k}/manifest-md5.txt", f"{good if k else '0' * 32}  data/Sample.csv\n")
        put(tmp_path / f"dd{k}/A_1.csv", "a\n1\n")
        put(tmp_path / f"dd{k}/A_dd.csv", f"Column_or_Row_Name,Unit,Definition\nsoil_temperature_{k}cm,degC,missing values = -{k}\n")
        put(tmp_path / f"dd{k}/sub/science-metadata.xml", EML)  # of no bag: declares nothing
    put(tmp_path / "bare/_notes.txt", "n")
    put(tmp_path / "stray.txt", "no package")
    idx = index_packages(spark, str(tmp_path))
    assert {r.dataset_id: r.standard for r in idx.standard.collect()} == {
        **{f"bag{k}": "dataone_bagit" for k in range(3)}, **{f"dd{k}": "ess_dive_dd" for k in range(3)}, "bare": "unknown"}
    assert [(r.dataset_id, r.relative_path) for r in idx.mismatches.collect()] == [("bag0", "data/Sample.csv")]
    got = {(r.dataset_id, r.variable): (r.raw_name, r.unit, r.crs_tier) for r in idx.variables.collect()}
    assert got == {
        **{(f"dd{k}", "soil_temperature"): (f"soil_temperature_{k}cm", "degC", "pdf") for k in range(3)},
        **{(f"bag{k}", "excess_ice_content"): ("EIC, %", "percent", "assumed-wgs84") for k in range(3)},
        **{(f"bag{k}", "GMC, %"): ("GMC, %", "pct", "assumed-wgs84") for k in range(3)}}
    files = {(r.dataset_id, r.relative_path): r for r in idx.files.collect()}
    assert files["dd2", "A_1.csv"].missing_sentinel == "-2" and files["bare", "_notes.txt"].bytes == 1 and len(files) == 3 * 7 + 1
    assert idx.fingerprint.count() == 7


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    """Three sparse gigabytes are hashed in pieces; no column holds them."""
    from cairn.sources.files import file_digests

    with open(tmp_path / "big.bin", "wb") as f:
        f.truncate(3 << 30)
    put(tmp_path / "deep/er/Ünïcode name.csv", "é")
    want = hashlib.sha256()
    for _ in range(3 << 7):
        want.update(bytes(8 << 20))
    got = {r.path: r for r in file_digests(spark, f"file://{tmp_path}").collect()}
    assert got["big.bin"].bytes == 3 << 30 and got["big.bin"].content_checksum == want.hexdigest()
    assert got["deep/er/Ünïcode name.csv"].md5 == hashlib.md5("é".encode()).hexdigest() and len(got) == 2
    assert [r.path for r in file_digests(spark, str(tmp_path / "big.bin")).select("path").collect()] == ["big.bin"]
    (tmp_path / "none").mkdir()
    assert file_digests(spark, str(tmp_path / "none")).count() == 0


def test_fingerprint(spark):
    f = spark.createDataFrame([("d", "b", 2), ("d", "a", 1)], "dataset_id string, relative_path string, bytes bigint")
    assert I.package_fingerprint(f).first().fingerprint == hashlib.sha256(b"a:1\nb:2").hexdigest()


def test_catalog_replace(spark, make_obs, tmp_path):
    cat = K.Catalog(spark, str(tmp_path / "cat")).create().create()
    first = make_obs([dict(obs_id="a", value=1.0), dict(obs_id="a", value=2.0), dict(obs_id="b", value=3.0)])
    assert cat.ingest(first, "one") == 2
    assert cat.ingest(make_obs([dict(obs_id="z", value=9.0)]), "two") == 1
    values = lambda: {(r.dataset_id, r.obs_id): r.value for r in cat.read("observations").collect()}
    assert values() == {("one", "a"): 2.0, ("one", "b"): 3.0, ("two", "z"): 9.0}
    assert cat.ingest(make_obs([dict(obs_id="c", value=4.0)]), "one") == 1
    assert values() == {("one", "c"): 4.0, ("two", "z"): 9.0}
    assert cat.ingest(first.filter("false"), "one") == 0
    assert values() == {("one", "c"): 4.0, ("two", "z"): 9.0}
    row = cat.read("observations").filter("obs_id = 'c'").first()
    assert row.qc_flags is None and row.extra is None


def test_catalog_upsert(spark, tmp_path):
    cat = K.Catalog(spark, str(tmp_path / "cat")).create()
    rows = lambda *names: spark.createDataFrame([(f"d{i}", "s", n) for i, n in enumerate(names)], "dataset_id string, source_id string, name string")
    cat.register("datasets", rows("x", "y"))
    cat.register("datasets", rows("new"))
    cat.register("datasets", rows("new"))
    assert {r.dataset_id: r.name for r in cat.read("datasets").collect()} == {"d0": "new", "d1": "y"}


def test_a_job_that_dies_before_the_commit(spark, make_obs, tmp_path, monkeypatch):
    """Several datasets in one ingest: all of them change, or none."""
    cat = K.Catalog(spark, str(tmp_path / "cat")).create()
    rows = lambda v: make_obs([dict(dataset_id=d, obs_id=f"{d}{i}", value=v) for d in ("a", "b", "c") for i in range(2)])
    cat.ingest(rows(1.0))
    held = lambda: sorted((r.dataset_id, r.value) for r in cat.read("observations").collect())
    old = [(d, 1.0) for d in "abc" for _ in range(2)]
    assert held() == old
    # written aside, not published
    monkeypatch.setattr(K.Catalog, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        cat.ingest(rows(2.0))
    assert held() == old
    monkeypatch.undo()
    # the write itself fails in one of the datasets
    broken = rows(3.0).withColumn("value", F.expr("if(dataset_id = 'b', raise_error('disk'), value)").cast("double"))
    with pytest.raises(Exception, match="disk"):
        cat.ingest(broken)
    assert held() == old
    assert cat.ingest(rows(4.0).filter("dataset_id <> 'c'")) == 4
    assert held() == [("a", 4.0), ("a", 4.0), ("b", 4.0), ("b", 4.0), ("c", 1.0), ("c", 1.0)]


def test_acquire_end_to_end(spark, tmp_path):
    root = tmp_path / "raw/pangaea/calm_alt"
    path = put(root / "calm.tsv", CALM)
    put(root / "PROVENANCE.json", '{"title": "T", "citation": "Real, A. (2020)"}')
    cat = K.Catalog(spark, str(tmp_path / "cat")).create()
    for _ in range(2):
        got = acquire(cat, land("calm_alt"), path, "CALM", index_root=str(root))
    assert got.n_observations == 3 and cat.read("observations").count() == 3
    assert cat.read("downloads").first().download_id == "calm_alt_abc123" and cat.read("package_files").count() == 1
    assert sorted(r.check for r in got.findings.collect()) == ["self_describing_missing", "self_describing_missing", "self_describing_no_native"]


def test_discovery(spark):
    caps = spark.createDataFrame([("a", "soil_temperature"), ("b", "ground_temperature"), ("c", "ndvi")], "source_id string, variable string")
    req = spark.createDataFrame([("soil_temperature",), ("elevation",)], "variable string")
    got = {r.variable: r.sources for r in D.sources_for_variables(req, caps).collect()}
    assert got == {"soil_temperature": ["a", "b"], "elevation": []}


def test_bbox_coverage_of_points(spark):
    boxes = spark.createDataFrame([(-150.0, 65.0, -150.0, 65.0), (-10.0, 65.0, -10.0, 65.0), (-180.0, -90.0, 180.0, 90.0), (None, None, None, None)], "w double, s double, e double, n double")
    q = (-160.0, 60.0, -140.0, 70.0)
    got = [r[0] for r in boxes.select(D.bbox_coverage(q, *[F.col(c) for c in "wsen"])).collect()]
    assert got[:2] == [1.0, 0.0] and 0 < got[2] < 0.01 and got[3] is None
    t = spark.createDataFrame([("2000-01-01", "2001-01-01"), ("bad", None)], "b string, e string")
    assert [r[0] for r in t.select(D.time_overlap(("2002", "x"), F.col("b"), F.col("e"))).collect()] == [True, True]
    assert [r[0] for r in t.select(D.time_overlap(("2002-01-01", "2003-01-01"), F.col("b"), F.col("e"))).collect()] == [False, True]


def test_same_id_in_two_datasets(make_obs):
    from cairn.operators import catalog as K

    obs = make_obs([dict(obs_id="x", dataset_id="a", value=1.0), dict(obs_id="x", dataset_id="b", value=2.0), dict(obs_id="x", dataset_id="a", value=3.0)])
    assert sorted((r.dataset_id, r.value) for r in K.stored_form(obs).collect()) == [("a", 3.0), ("b", 2.0)]


def test_dictionaries_by_their_own_header_and_all_codes(spark, tmp_path):
    from cairn.sources import package as K

    (tmp_path / "metadata").mkdir()
    (tmp_path / "a_dd.csv").write_text("nothing,here\n1,2\n")
    (tmp_path / "b_dd.csv").write_text("Column_or_Row_Name,Unit,Definition,Column_or_Row_Long_Name,Data_Type\nt,degC,d,l,n\n")
    (tmp_path / "c_dd.csv").write_text("Unit,Column_or_Row_Name,Definition,Column_or_Row_Long_Name,Data_Type\nm,z,d,l,n\n")
    assert sorted((r.raw_name, r.unit) for r in K.dictionary_rows(spark, str(tmp_path), "d").collect()) == [("t", "degC"), ("z", "m")]
    (tmp_path / "metadata/science-metadata.xml").write_text(
        "<eml><dataTable><entityName>e.csv</entityName><attributeList><attribute><attributeName>t</attributeName>"
        "<missingValueCode><code>-99</code></missingValueCode><missingValueCode><code>-88</code></missingValueCode></attribute></attributeList></dataTable></eml>")
    rows = K.eml_attributes(spark, str(tmp_path), "d").orderBy("ord").collect()
    assert [(r.raw_name, r.missing_sentinel) for r in rows] == [("t", "-99"), ("t", "-88")]


def test_packages_are_read_through_one_listing(spark, tmp_path):
    """No table lists or opens the packages' files again, whatever their texts look like."""
    for k in range(3):
        put(tmp_path / f"bag{k}/bagit.txt", "BagIt")
        put(tmp_path / f"bag{k}/data/Sample.csv", "x\n")
        put(tmp_path / f"bag{k}/metadata/science-metadata.xml", EML.replace(
            "<dataTable><entityName>Other", "<!-- <dataTable><entityName>Sample.csv</entityName> --><dataTable id='a>b'><entityName>Other"))
        put(tmp_path / f"bag{k}/manifest-md5.txt", f"\ufeff{'0' * 32}  data/Sample.csv\r\n")
        put(tmp_path / f"dd{k}/A_1.csv", "a\n1\n")
        put(tmp_path / f"dd{k}/A_dd.csv", f'\ufeffColumn_or_Row_Name,Unit,Definition\r\nx{k},"deg\r\nC",\r\n')
        put(tmp_path / f"dd{k}/_old/B_dd.csv", "Column_or_Row_Name,Unit,Definition\nhidden,m,\n")
    idx = index_packages(spark, str(tmp_path))
    for table in (idx.files, idx.variables, idx.mismatches, idx.standard, idx.fingerprint):
        assert not [f for f in table.inputFiles() if str(tmp_path) in f]
    assert sorted((r.dataset_id, r.variable, r.unit) for r in idx.variables.collect()) == sorted(
        [(f"bag{k}", v, u) for k in range(3) for v, u in (("excess_ice_content", "percent"), ("GMC, %", "pct"))] + [(f"dd{k}", f"x{k}", "deg\nC") for k in range(3)])
    assert sorted((r.dataset_id, r.declared_md5) for r in idx.mismatches.collect()) == [(f"bag{k}", "0" * 32) for k in range(3)]


def test_settled_roster_rows_skip_the_later_steps(spark, tmp_path):
    """All four steps, rows without a site code, and names that are read once."""
    names = ["US_A_1_2020_01_01.csv", "US_A_2_2020_01_02.csv", "US_B_1_2021_01_01.csv", "US_B_2_2022_01_01.csv", "US_C_7_x.csv"]
    spark.createDataFrame([("d", n) for n in names * 2], "dataset_id string, file_name string").write.parquet(str(tmp_path / "names"))
    asked = [
        ("d", "US_A_1_2020_01_01.csv", "", None, 1), ("d", "US_A_2_2020-01-02", None, None, 2), ("d", "gone", "US_C_7", None, 3),
        ("d", "gone", "US_B_9", "2022_01_01", 4), ("d", "gone", "US_C_8", None, 4), ("d", "gone", "", "2021_01_01", None),
        ("d", "gone", None, None, None), ("e", "US_A_1_2020_01_01.csv", "US_A_1", None, None), ("d", None, "US_C_7", None, 3),
    ]
    w = spark.createDataFrame([(*a[:4], i) for i, a in enumerate(asked)], "dataset_id string, filename string, site_code string, date_token string, ord int")
    found = I.resolve_by_steps(w, spark.read.parquet(str(tmp_path / "names")))
    assert not [f for f in found.inputFiles() if str(tmp_path / "names") in f]
    got = {r.ord: (r.step, r.file_name) for r in found.collect()}
    at = {0: 0, 1: 1, 2: 4, 3: 3, 4: 4, 8: 4}
    assert got == {i: (asked[i][4], names[at[i]]) for i in at}


def test_texts_are_cut_alike_in_pieces_of_any_size():
    from cairn.sources.files import Elements, Lines

    def cut(cutter, data, n):
        return [x for i in range(0, len(data), n) for x in cutter.feed(data[i : i + n])] + cutter.close()

    xml = (b"<?xml?><!-- <t>no</t> --><x><t id='a>b'><n>1</n><![CDATA[</t>]]></t><ts/><t/><t>\r\n<t>in</t><!-- </t> --> x</t ><t>open")
    for n in range(1, len(xml) + 1):
        assert cut(Elements("t"), xml, n) == [b"<t id='a>b'><n>1</n><![CDATA[</t>]]></t>", b"<t>\r\n<t>in</t><!-- </t> --> x</t >"]
    for n in range(1, 12):
        assert cut(Lines(), b"a\r\n\r\nb\rc\n\rd", n) == [b"a", b"", b"b", b"c", b"", b"d"] and cut(Lines(), b"a\r\n", n) == [b"a"]


def test_many_requests_against_many_boxes(spark):
    """Boxes of every size against brute force: each pair once, no nested loop."""
    import random

    from cairn.operators import requests as Q

    rng = random.Random(11)

    def box():
        if rng.random() < 0.1:
            return (-180.0, -90.0, 180.0, 90.0)
        size = rng.choice([0.0, 0.5, 3.0, 14.0, 60.0, 150.0])
        w, s = round(rng.uniform(-180, 180 - size), 1), round(rng.uniform(-90, 90 - size / 2), 1)
        return (w, s, w + size, s + size / 2)

    sets = [(f"d{k}", *box()) for k in range(120)] + [("edge", 10.0, 10.0, 15.0, 15.0), ("none", None, None, None, None)]
    asked = [(k, *box()) for k in range(60)] + [(90, 15.0, 15.0, 20.0, 20.0), (91, None, None, None, None)]
    meta = spark.createDataFrame([(*d, k, "2000-01-01", None, None, "t") for k, d in enumerate(sets)],
        "dataset_id string, west double, south double, east double, north double, rank int, begin_date string, end_date string, superseded_by string, text string")
    req = spark.createDataFrame(asked, "request_id int, west double, south double, east double, north double").selectExpr(
        "*", "string(null) as begin", "string(null) as end", "cast(null as array<string>) as terms")
    found = Q.overlapping(req, meta)
    got = sorted((r.r_request_id, r.dataset_id) for r in found.collect())
    want = []
    for k, *q in asked:
        w, s, e, n = q if q[0] is not None else (-180, -90, 180, 90)
        want += [(k, d) for d, a, b, c, f in sets if a is not None and c >= w and a <= e and f >= s and b <= n]
    assert got == sorted(want) and (90, "edge") in got
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert Q.search_by_overlap(meta, req, rows=None).count() == len(want)
    assert max(r["count"] for r in Q.search_by_coverage(meta, req, rows=2).groupBy("request_id").count().collect()) == 2


def test_requests_that_are_alike_meet_once(spark, monkeypatch):
    """Copies of boxes are one class: far fewer pairs are compared than found, and classes of any size come out whole."""
    from cairn.operators import requests as Q

    monkeypatch.setattr(Q, "_ALIKE", 7)
    monkeypatch.setattr(Q, "_CROWD", 2)
    meta = spark.range(300).selectExpr(
        "concat('d', id) as dataset_id", "if(id % 3 = 0, 10D, 50D) as west", "10D as south", "if(id % 3 = 0, 12D, 52D) as east", "12D as north",
        "300 - id as rank", "if(id % 2 = 0, '2000-01-01', null) as begin_date", "if(id % 2 = 0, '2001-01-01', null) as end_date",
        "cast(null as string) as superseded_by", "if(id % 5 = 0, 'Snow Depth', 'ice') as text")
    req = spark.range(40).selectExpr(
        "id as request_id", "if(id % 2 = 0, 9D, null) as west", "9D as south", "if(id % 2 = 0, 20D, null) as east", "20D as north",
        "'1999-01-01' as begin", "'2002-01-01' as end", "if(id % 4 = 0, array('snow_depth', ' '), null) as terms")
    compared = []
    meet = Q._meet
    monkeypatch.setattr(Q, "_meet", lambda a, m: compared.append(a.count() * m.count()) or meet(a, m))
    got = Q.search_by_coverage(meta, req, rows=None)
    assert got.count() == 20 * 100 + 20 * 300 and max(compared) <= 8
    assert got.select("request_id", "dataset_id").distinct().count() == got.count()
    top = Q.search_by_coverage(meta, req, rows=2).collect()
    assert sorted((r.request_id, r.dataset_id) for r in top) == sorted(
        (k, d) for k in range(40) for d in (("d297", "d294") if k % 2 == 0 else ("d299", "d298")))
    said = Q.search_by_overlap(meta, req, rows=None)
    want = sum(1 for k in range(40) for d in range(0, 300, 2) if (k % 2 or d % 3 == 0) and (k % 4 or d % 5 == 0))
    assert said.count() == want and max(compared) <= 12
    assert Q.search_by_overlap(meta, req, rows=3).count() == 120


def test_requests_are_expanded_in_the_tasks_of_the_session(spark, monkeypatch):
    """Rows are made in the last stage: it is not cut by the few bytes it reads, even where nearly all datasets are one class."""
    from cairn.operators import requests as Q

    monkeypatch.setattr(Q, "_ALIKE", 50)
    monkeypatch.setattr(Q, "_ASKING", 5, raising=False)
    meta = spark.range(300).selectExpr(
        "concat('d', id) as dataset_id", "10D as west", "10D as south", "12D as east", "if(id = 0, 13D, 12D) as north", "id as rank",
        "'2000-01-01' as begin_date", "'2001-01-01' as end_date", "cast(null as string) as superseded_by", "if(id % 5 = 0, 'Snow Depth', 'ice') as text")
    req = spark.range(100).selectExpr(
        "id as request_id", "9D as west", "9D as south", "20D as east", "20D as north", "'1999-01-01' as begin", "'2002-01-01' as end",
        "if(id % 4 = 0, array('snow_depth'), null) as terms")
    for found, want in ((Q.search_by_coverage(meta, req, rows=None), 30_000), (Q.search_by_overlap(meta, req, rows=None), 75 * 300 + 25 * 60)):
        seen = found.select("request_id", "dataset_id", F.spark_partition_id().alias("task")).collect()
        assert len(seen) == len({(r.request_id, r.dataset_id) for r in seen}) == want
        assert len({r.task for r in seen}) == 4  # spark.sql.shuffle.partitions of this session


def test_sizes_round_like_printf(spark):
    from cairn.functions.text import format_bytes

    sizes = [0, 1023, 1024, 22784, 33024, 1048575, 1048576, 1310720, 1363149, 5 << 28, (1 << 30) + 5368709, 10**13] + [256 * k for k in range(4, 400, 7)]
    got = spark.createDataFrame([(n,) for n in sizes], "n bigint").select("n", format_bytes(F.col("n"))).collect()
    scale = lambda n: f"{n}B" if n < 1024 else f"{n / 1024:.1f}KB" if n < 1 << 20 else f"{n / (1 << 20):.1f}MB" if n < 1 << 30 else f"{n / (1 << 30):.2f}GB"
    assert [(n, s, scale(n)) for n, s in got if s != scale(n)] == []
