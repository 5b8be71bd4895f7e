"""Readers on small files written here: traps of each source layout."""

import csv
import io
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cairn.sources import delimited as D
from cairn.sources import readers as R
from cairn.sources import registry
from cairn.sources.normalise import Landing

NOW = datetime(2024, 1, 2)


def land(source):
    return Landing(source, source, "https://x.org", NOW, "abc123", "CC-BY-4.0")


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_slugs_search_each_text_once_and_are_spread(spark, tmp_path):
    """Also where all texts are one row group; odd texts as before."""
    from cairn.functions import parse as P
    from queries import sources

    odd = {"": "unknown", "_": "unknown", "é ü": "unknown", None: "unknown", "_a__b_": "a_b", "  x": "x", "y\n": "y", "Ünï-code\U0001f600Z9": "n_code_Z9", "a": "a", "0": "0"}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id bigint, text string")
    assert [r.s for r in rows.orderBy("doc_id").select(P.slug(F.col("text")).alias("s")).collect()] == list(odd.values())
    rows.unionAll(spark.range(10, 200).select("id", F.lit("a b"))).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    found = sources.slugs(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "RepartitionByExpression" in plan
    assert found.count() == 200


CALM = """/* Dataset: thaw depth
 more text */
Event label\tSite\tName\tIdentification\tCountry\tArea/locality\tLatitude of event\tLongitude of event\tDATE/TIME\tALD [cm]\tSample comment\tComment
U1_20\tU1\tNorth\tG1\tUS\tSlope\t71.3\t-156.6\t2020\t38.5
U1_21\tU1\tNorth\tG1\tUS\tSlope\t71.3\t-156.6\t2021\t-\t\tmissing

U2_21\tU2\tWest\tG2\tUS\tHill\t65.4\t-164.6\t2021-08-03\t160\t\trefusal
R1_20\tR1\tEast\tG3\tRU\tYamal\t69.7\t66.8\t2020\t120
"""


def test_calm(spark, tmp_path):
    o = R.read_calm(spark, put(tmp_path / "calm.tsv", CALM), land("calm_alt")).orderBy("obs_id").collect()
    assert [r.obs_id for r in o] == ["calm_R1_20_2020", "calm_U1_20_2020", "calm_U2_21_2021-08-03"]
    assert [r.qc_flags for r in o] == [[], [], ["possible_probe_refusal"]]
    assert abs(o[1].value - 0.385) < 1e-12 and o[1].depth_m == 0.0 and o[1].unit == "m"
    assert o[1].provenance.source_id == "calm_alt" and o[1].provenance.license == "CC-BY-4.0"
    assert o[1].time_start == datetime(2020, 1, 1) and o[1].extra["site_name"] == "North"


def test_native_metadata(spark, tmp_path):
    text = D.comment_block(D.text_lines(spark, put(tmp_path / "calm.tsv", CALM))).first().native_metadata
    assert text == "/* Dataset: thaw depth\n more text */"


GTNP = """/* a */
/* b */
Event\tName\tLatitude\tLongitude\tDate/Time\tDEPTH, sediment/rock [m]\tTemp [°C]\tReference/source\tReference/source
B1\tDead\t70.161\t-148.465\t2015\t0.0\t-5.2\tfirst\tsecond
B1\tDead\t70.161\t-148.465\t2015\t1.0\t-6.8\tfirst\tsecond
B1\tOther\t70.5\t-148.465\t2015\t1.0\t-6.0\tfirst\tsecond
B2\tGal\t68.4\t-149.5\t2010\t10.0\t\tfirst\tsecond
"""


def test_gtnp(spark, tmp_path):
    o = R.read_gtnp(spark, put(tmp_path / "g.tsv", GTNP), land("gtnp_magt")).orderBy("ord").collect()
    assert [r.depth_m for r in o] == [0.0, 1.0, 1.0] and len({r.obs_id for r in o}) == 3
    assert o[0].obs_id == "gtnp_B1_Dead_0.0m_2015_70.1610_-148.4650"
    assert o[0].obs_type == "profile" and o[0].extra["reference_original"] == "second"


def test_above(spark, tmp_path):
    text = """site_name,latitude,longitude,date,ALT,VWC,depth_top,depth_bottom
B,71.3,-156.6,2015-08-15,38.5,-999,-999,-999
B,71.3,-156.6,8/15/2015,-999,45.0,10,20
B,bad,-156.6,2015-08-15,1,-999,-999,-999
B,71.3,-156.6,2015-08-17,-999,142.0,10,20
"""
    o = R.read_above(spark, put(tmp_path / "a.csv", text), land("above_stdm")).orderBy("ord").collect()
    assert [r.obs_id for r in o] == ["above_above_stdm_000000_ALT", "above_above_stdm_000001_VWC", "above_above_stdm_000003_VWC"]
    assert [round(r.value, 6) for r in o] == [0.385, 0.45, 1.42] and [r.depth_m for r in o] == [None, 0.15, 0.15]
    assert o[1].time_start == datetime(2015, 8, 15)


def test_thaw(spark, tmp_path):
    text = """Authors,DOI,DataSourceType,FeatureName,Latitude,Longitude,FeatureType,FeatureCategory,ThawType,Imagery,ImageryDates,ImageryResolution_meters
"Doe, J",10.1/x,paper,F1,65.1,-150.2,t,Thaw pond,abrupt,i,d,1
Doe,10.1/x,paper,F2,,-150.2,t,Thaw pond,abrupt,i,d,1
Doe – Roe,10.1/x,paper,F3,65.3,-150.4,t,Something else,abrupt,i,d,1
"""
    o = R.read_thaw_features(spark, put(tmp_path / "w.csv", text, "cp1252"), land("webb_2026_alaska_thaw_db"), "cp1252").orderBy("ord").collect()
    assert [(r.obs_id, r.value) for r in o] == [("thawdb_00000_65.100_-150.200", 2.0), ("thawdb_00002_65.300_-150.400", -1.0)]
    assert o[0].obs_type == "event" and o[0].time_start is None and o[0].extra["authors"] == "Doe, J" and "–" in o[1].extra["authors"]


def test_sloan(spark, tmp_path):
    p = tmp_path / "pkg"
    put(p / R.SLOAN_LOCATIONS, "region,plot_ID,northing,easting\nN/A,N/A,m,m\n" + "".join(f"NA,A1C,{7910000 + d},{586000 + d}\n" for d in (0, 2)) + "NA,A1C,-9999,-9999\n")
    put(p / R.SLOAN_LONG_FILE, """region,site,area,polygon_ID,polygon_sub_unit,plot_ID,polygon_type,date,time,depth,temperature
N/A,N/A,N/A,N/A,N/A,N/A,N/A,N/A,N/A,cm,degC
NA,B,A,P,C,A1C,low,2012-09-01,20:30,5,1.5
NA,B,A,P,C,A1C,low,2012-09-01,21:00,5,-9999
NA,B,A,P,C,ZZZ,low,2012-09-01,21:00,5,1.0
""")
    for plot in ("A1C", "XYZ"):
        put(p / f"BEO_soil_additional_temperature_plot{plot}_15cm_2013_2014.csv", f"\"{R.SLOAN_TIME}\",\"{R.SLOAN_TEMP}\"\n2013-09-01 8:30,15.2\n2013-09-01 9:30,-9999\n")
    o = R.read_sloan(spark, str(p), land("sloan_2014_barrow_soil")).orderBy("obs_id").collect()
    assert [r.obs_id for r in o] == [
        "sloan_2014_barrow_soil_30min_A1C_5cm_20120902T053000Z", "sloan_2014_barrow_soil_perplot_A1C_15cm_20130901T163000Z"]
    assert [r.depth_m for r in o] == [0.05, 0.15] and 71 < o[0].latitude < 72 and o[0].latitude == o[1].latitude


def test_kanevskiy(spark, tmp_path):
    head = '"Table, 1. ",,,,,,\n,,,,,,\n'
    put(tmp_path / "data/A_June_2019.csv", head + 'Borehole ,Date,Coordinates,,"Sample depth, ","EIC, ",Notes\n,,Latitude,Longitude,cm,"%,",\nIRT-1/19,6/30/2019,69.5,-150.8,76-87,13.4,x\nIRT-1/19,6/30/2019,69.5,-150.8,80,0,zero\nIRT-1/19,6/30/2019,69.5,-150.8,,,blank\n')
    put(tmp_path / "data/B_July_2020.csv", head + '"Borehole (B) Exposure (E) ",Date,Coordinates,,"Sample depth, ","EIC, %",Notes\n,,Latitude,Longitude,cm,,\nBY-1 (B),7/28/19,73.15° ,-79.95º,60,25.0,deg\nIRT-1/19,6/30/2019,69.5,-150.8,80,0,again\n')
    put(tmp_path / "data/C_May_2023.csv", head + 'Borehole,Date,Coordinates ,,"Sample depth, ","EIC, ",Notes\n,,,,cm,"%,",\nN40,5/3/2023,71.27,-156.45,55,8.5,positional\n')
    put(tmp_path / "data/Utqiagvik_July_2023.csv", head + "Borehole,Date\n,\nX,1/1/2020\n")
    put(tmp_path / "data/D_other.csv", head + "Name,Value\n,\nX,1\n")
    o = {r.obs_id: r for r in R.read_kanevskiy(spark, str(tmp_path), land("kanevskiy_2024_cryostratigraphy")).collect()}
    assert set(o) == {
        "kanevskiy_IRT_1_19_69.5000_-150.8000_82cm_20190630", "kanevskiy_IRT_1_19_69.5000_-150.8000_80cm_20190630",
        "kanevskiy_BY_1_B_73.1500_-79.9500_60cm_20190728", "kanevskiy_N40_71.2700_-156.4500_55cm_20230503"}
    assert o["kanevskiy_IRT_1_19_69.5000_-150.8000_80cm_20190630"].value == 0.0
    assert o["kanevskiy_IRT_1_19_69.5000_-150.8000_80cm_20190630"].extra["source_file"] == "A_June_2019.csv"
    assert o["kanevskiy_IRT_1_19_69.5000_-150.8000_82cm_20190630"].depth_m == 0.815


def test_tsp(spark, tmp_path):
    bom = "﻿"
    put(tmp_path / "data/T_SitesRoster.csv", bom + "SiteCountry,SiteCode,SiteCodeHistorical,GTNP_ID,SiteName,Latitude,Longitude,ObservationDate,Filename\n"
        "US,US_BRW_101,B,U1,Barrow 1,71.3,-156.6,07/27/23,US_BRW_101_2023_07_27.csv\n"
        "US,US_BLK_001,B,U2,Black,65.3,-146.6,,US_BLK_001_2016-08-16\n"
        "US,US_TLK_005,B,U3,Lake,68.6,-149.6,06/01/23,US_TLK_005_wrong.csv\n"
        "US,US_XXX_001,X,,None,65.0,-147.0,06/01/23,US_XXX_001_2023_06_01.csv\n"
        "US,US_CPT_101,C,U4,College,64.86,-147.78,10/03/23,US_CPT_101_2023_10_03.csv\n")
    put(tmp_path / "data/US_BRW_101_2023_07_27.csv", bom + "Depth_m,Temperature_C\n12,-6.9\n14,-7.0\n,\n16,\n")
    put(tmp_path / "data/US_BLK_001_2016_08_16.csv", bom + "Temp (C),Depth (m)\n-1.0,2\n")
    put(tmp_path / "data/US_TLK_005_2023_06_01.csv", bom + "Depth_m,Temperature_C\n1,-2\n")
    put(tmp_path / "data/US_CPT_001_2023_10_03.csv", bom + "Depth_m,Temperature_C\n1,-1.5\n3,-2.1\n")
    o = R.read_tsp(spark, str(tmp_path), land("tsp_north_america_ground_temperature")).orderBy("obs_id").collect()
    assert [(r.obs_id, r.value) for r in o] == [
        ("tsp_US_BLK_001_20160816_200cm", -1.0), ("tsp_US_BRW_101_20230727_1200cm", -6.9), ("tsp_US_BRW_101_20230727_1400cm", -7.0),
        ("tsp_US_CPT_101_20231003_100cm", -1.5), ("tsp_US_CPT_101_20231003_300cm", -2.1), ("tsp_US_TLK_005_20230601_100cm", -2.0)]


def test_row_numbers_over_many_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for name, n in (("a", 9000), ("b", 3000)):
            put(tmp_path / f"{name}.csv", "".join(f"{name},{i}\n" for i in range(n)))
        lines = D.text_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        wrong = lines.filter(F.split("line", ",")[1].cast("long") != F.col("ord")).count()
        assert wrong == 0 and lines.count() == 12000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_each_file_by_its_own_header(spark, tmp_path):
    put(tmp_path / "x/a.tsv", "/* c */\nA\tB\n1\t2\n")
    put(tmp_path / "x/b.tsv", "/* c */\nC\tA\n3\t4\n")
    rows = D.commented_table(spark, str(tmp_path / "x")).orderBy("file_name").collect()
    assert [(r.A, r.B, r.C) for r in rows] == [("1", "2", None), ("4", None, "3")]
    put(tmp_path / "y/a.csv", "A,B\n1,2\n")
    put(tmp_path / "y/b.csv", "B,A\n3,4\n")
    assert sorted((r.A, r.B) for r in D.csv_rows(spark, str(tmp_path / "y")).collect()) == [("1", "2"), ("4", "3")]


def test_comment_block_of_any_length(spark, tmp_path):
    put(tmp_path / "a.tsv", "/* start\n" + "x\n" * 5000 + "end */\n/* more */\nA\tB\n1\t2\nends */\t3\n")
    assert [(r.A, r.B, r.ord) for r in D.commented_table(spark, str(tmp_path / "a.tsv")).orderBy("ord").collect()] == [("1", "2", 5004), ("ends */", "3", 5005)]
    assert D.comment_block(D.text_lines(spark, str(tmp_path / "a.tsv"))).first().native_metadata.count("\n") == 5001


def test_records_keep_quoted_line_breaks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        put(tmp_path / "a.csv", "A,B\n" + "".join(f'{i},"line ""one""\n\nline, {i}"\n\n{i},\n' for i in range(400)))
        rows = D.csv_rows(spark, str(tmp_path / "a.csv"), numbered=True).orderBy("ord").collect()
        assert [r.ord for r in rows] == list(range(800))
        assert all(r.B == f'line "one"\n\nline, {r.A}' for r in rows[::2]) and all(r.B is None for r in rows[1::2])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lone_quotes_in_unquoted_fields_are_letters(spark, tmp_path):
    block = '{i},5" core,x\n{i},plain,y\n{i},"quoted ""x"", y",z\n{i},a"b"c" d,"two\n{i}, 6"" lines"" ,\n"\n{i},"shut","\n"\n{i},,"a\n"" b,""\n\nc",\n'
    text = "A,B,C\n" + "".join(block.replace("{i}", str(i)) for i in range(150))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        put(tmp_path / "a.csv", text)
        rows = D.csv_rows(spark, str(tmp_path / "a.csv"), numbered=True).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [[c or None for c in r[:3]] for r in list(csv.reader(io.StringIO(text)))[1:]]
    assert len(want) == 900 and [[r.A, r.B, r.C] for r in rows] == want
    put(tmp_path / "b.csv", 'A\tB\n1\t5" core, wet\n2\t"a\tb\n"\n3\tx\n')
    rows = D.csv_rows(spark, str(tmp_path / "b.csv"), sep="\t", numbered=True).orderBy("ord").collect()
    assert [(r.A, r.B) for r in rows] == [("1", '5" core, wet'), ("2", "a\tb\n"), ("3", "x")]


def test_cells_of_any_number_and_optional_concepts(spark, tmp_path):
    put(tmp_path / "a.csv", ",".join(f"c{i}" for i in range(200)) + "\n" + ",".join(map(str, range(200))) + "\n")
    put(tmp_path / "b.csv", 'c1,c2\n"x,y",""\n')
    lines = D.text_lines(spark, str(tmp_path))
    rows = D.per_file_columns(lines, (0,), {"one": ("c1",), "far": ("c199",)}, required=("one",)).orderBy("file_name").collect()
    assert [(r.one, r.far) for r in rows] == [("1", "199"), ("x,y", "")]
    assert D.per_file_columns(lines, (0,), {"one": ("c1",), "far": ("c199",)}).count() == 1
    assert [(r.file[-5:], r.concept) for r in D.missing_concepts(lines, (0,), {"one": ("c1",), "far": ("c199",)}).collect()] == [("b.csv", "far")]


def test_registry(spark):
    caps = registry.capabilities(spark)
    assert caps.count() == 8 and registry.get_source("calm_alt").serves == ("active_layer_thickness",)
    with pytest.raises(KeyError):
        registry.get_source("nope")
