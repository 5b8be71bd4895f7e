"""Source normalisers over raw text columns derived from the given tables."""

from pyspark.sql import functions as F

from cairn.dims import FEATURE_CATEGORIES
from cairn.functions import parse as P
from cairn.operators import index as I
from cairn.sources import delimited as D
from cairn.sources import normalise as N
from queries import views as V
from queries.checks import r6
from queries.grids import utm_sql


def _landing(source):
    return N.Landing(source, f"{source}_set")


def _flat(obs):
    return obs.select(
        "obs_id", "obs_type", "variable", r6("value").alias("value"), "unit",
        r6("latitude").alias("latitude"), r6("longitude").alias("longitude"), r6("depth_m").alias("depth_m"),
        F.date_format("time_start", "yyyy-MM-dd HH:mm:ss").alias("time_start"),
        F.array_join("qc_flags", ",").alias("qc_flags"),
    )


# text pieces that read the same in both engines
_EVENT_LAT = "cast(60.0 + user_id % 29 as {t})"
_EVENT_LON = "cast(-165.0 + user_id % 30 as {t})"


def _both(text):
    """One expression as (Spark SQL, DuckDB SQL)."""
    return text.replace("{t}", "string"), text.replace("{t}", "varchar")


def _raw(names):
    spark = [f"{_both(e)[0]} as `{n}`" for n, e in names.items()]
    duck = ", ".join(f"{_both(e)[1]} as \"{n}\"" for n, e in names.items())
    return spark, duck


CALM_RAW = {
    "Event label": "case when event_id % 9 = 0 then '' else 'U' || user_id end",
    "Event": "'E' || user_id",
    "Latitude of event": "case when event_id % 50 = 7 then 'north' else " + _EVENT_LAT + " end",
    "Longitude of event": _EVENT_LON,
    "DATE/TIME": "case event_id % 4 when 0 then cast(1990 + event_id % 30 as {t}) when 1 then '2015-08-' || (10 + event_id % 20) when 2 then '2015-8-3' else '2016-07-01T10:20:30' end",
    "ALD [cm]": "case when event_id % 6 = 0 then '-' when event_id % 6 = 1 then ' ' when event_id % 6 = 2 then 'n/a' else ' ' || cast(value * 8 as {t}) end",
}
GTNP_RAW = {
    "Event": "'M' || (user_id % 9)",
    "Name": "' st ' || user_id",
    "Latitude": _EVENT_LAT,
    "Longitude": _EVENT_LON,
    "Date/Time": "cast(1980 + event_id % 40 as {t})",
    "DEPTH, sediment/rock [m]": "case when event_id % 3 = 0 then '' else cast(event_id % 20 as {t}) end",
    "Depth sed [m]": "case when event_id % 9 = 0 then 'deep' else cast(event_id % 7 as {t}) || '.5' end",
    "MAGT [°C]": "case when event_id % 4 = 0 then '' when event_id % 4 = 1 then '-' else cast(value - 9 as {t}) end",
    "Temp [°C]": "case when event_id % 8 = 0 then '' else cast(value - 3 as {t}) end",
}
ABOVE_RAW = {
    "Latitude": _EVENT_LAT,
    "longitude": _EVENT_LON,
    "date": "case event_id % 3 when 0 then '8/3/2012' when 1 then '2012-08-03' else 'soon' end",
    "ALT": "case when event_id % 2 = 0 then '-999' else cast(value as {t}) end",
    "Soil Moisture": "case when event_id % 3 = 0 then '-999' when event_id % 3 = 1 then '' else cast(value * 2 as {t}) end",
    "depth_top": "case when event_id % 5 = 0 then '-999' else cast(event_id % 40 as {t}) end",
    "depth_bottom": "case when event_id % 7 = 0 then '' else cast(event_id % 40 + 10 as {t}) end",
    "Depth_cm": "case when event_id % 10 = 0 then '25' else '' end",
}


def _events(spark, sf, names):
    return V.table(spark, sf, "events").selectExpr(*_raw(names)[0], "event_id as ord")


def _raw_sql(names):
    return f"raw as (select {_raw(names)[1]}, event_id as ord, value, user_id, event_id from events)"


def source_calm(spark, sf):
    return _flat(N.calm(_events(spark, sf, CALM_RAW), _landing("calm_alt")))


def source_gtnp(spark, sf):
    return _flat(N.gtnp(_events(spark, sf, GTNP_RAW), _landing("gtnp_magt")))


def source_above(spark, sf):
    return _flat(N.above(_events(spark, sf, ABOVE_RAW), _landing("above_stdm")))


def unpivot_wide(spark, sf):
    return N.unpivot_measured(_events(spark, sf, ABOVE_RAW)).select("ord", "col_name", "raw", "variable")


def source_thaw(spark, sf):
    names = ", ".join(f"'{c}'" for c in FEATURE_CATEGORIES)
    rows = V.table(spark, sf, "part").selectExpr(
        "cast(60.0 + p_size % 9 as string) as Latitude",
        "if(p_partkey % 31 = 5, null, cast(-150.5 as string)) as Longitude",
        f"if(p_partkey % 11 = 10, p_name, get(array({names}), cast(p_partkey % 11 as int))) as FeatureCategory",
        "p_type as ThawType", "p_partkey as ord",
    )
    return _flat(N.thaw_features(rows, _landing("webb_2026_alaska_thaw_db")))


def _corners(spark, sf):
    return V.table(spark, sf, "supplier").selectExpr(
        "'NA' as region", "concat('P', s_suppkey % 90) as plot_ID",
        "cast(7900000 + s_suppkey * 3 as string) as northing", "cast(580000 + s_suppkey * 7 as string) as easting",
    )


def source_sloan_long(spark, sf):
    rows = V.table(spark, sf, "lineitem").selectExpr(
        "case when l_linenumber = 9 then 'N/A' else 'AK' end as region", "concat(' P', l_suppkey) as plot_ID",
        "date_format(l_shipdate, 'yyyy-MM-dd') as date", "concat(l_partkey % 24, ':', lpad(cast(l_orderkey % 60 as string), 2, '0')) as time",
        "if(l_partkey % 13 = 0, '-9999', cast(l_linenumber * 5 as string)) as depth",
        "case when l_partkey % 17 = 0 then '-9999' when l_partkey % 19 = 0 then 'NA' else cast(l_quantity - 30 as string) end as temperature",
        "l_linestatus as area", "l_returnflag as polygon_sub_unit", "'' as polygon_type", "'' as polygon_ID", "'B' as site",
        "'long.csv' as file_name", "l_orderkey as ord",
    )
    return _flat(N.sloan_long(rows, N.plot_centroids(_corners(spark, sf)), _landing("sloan_2014_barrow_soil")))


def source_sloan_plots(spark, sf):
    rows = V.table(spark, sf, "orders").selectExpr(
        "concat('BEO_plotP', o_custkey % 120, '_', 5 * (1 + o_custkey % 3), 'cm_2013_2014.csv') as file_name",
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' ', o_orderkey % 24, ':30') as time_text",
        "if(o_orderkey % 23 = 0, '-9999', cast(o_totalprice / 1000 as string)) as temp_text", "o_orderkey as ord",
    )
    return _flat(N.sloan_per_plot(rows, N.plot_centroids(_corners(spark, sf)), _landing("sloan_2014_barrow_soil")))


def _kanevskiy_rows(spark, sf):
    return V.table(spark, sf, "orders").selectExpr(
        "concat('campaign_', o_custkey % 5, '.csv') as file_name", "o_orderkey as ord",
        "if(o_orderkey % 29 = 0, '', concat('BH-', o_custkey % 70, ' (B)')) as borehole",
        "concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) as date",
        "concat(70 + o_custkey % 3, '.25° ') as latitude", "concat('-', 150 + o_custkey % 4, '.5º') as longitude",
        "case o_orderkey % 4 when 0 then concat(o_custkey % 90, '-', o_custkey % 90 + 11) when 1 then '' else cast(o_custkey % 300 as string) end as sample_depth",
        "case when o_orderkey % 6 = 0 then '' when o_orderkey % 6 = 1 then '0' else cast(o_orderkey % 100 as string) end as eic",
    )


def source_kanevskiy(spark, sf):
    return _flat(N.kanevskiy(_kanevskiy_rows(spark, sf), _landing("kanevskiy_2024_cryostratigraphy")))


ROSTER_SPARK = (
    "concat('set_', o_orderkey % 20) as dataset_id", "o_orderkey as ord",
    "concat('US_R', o_custkey % 50) as region", "concat('US_R', o_custkey % 50, '_', o_orderkey) as code",
    "date_format(o_orderdate, 'yyyy_MM_dd') as day", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
)
_FILENAME = """case o_orderkey % 4 when 0 then {c} || '_' || day || '.csv' when 1 then {c} || '_' || replace(day, '_', '-')
  when 2 then {c} || '_' || '1999_01_01.csv' else region || '_x' || o_orderkey || '_' || day || '.csv' end"""


def _roster(spark, sf):
    o = V.table(spark, sf, "orders").selectExpr(*ROSTER_SPARK)
    site = o.selectExpr(
        "dataset_id", "ord", _FILENAME.format(c="code") + " as filename",
        "if(o_orderkey % 4 = 3, concat(region, '_x', o_orderkey), code) as site_code",
    ).withColumn("date_token", P.date_token(F.col("filename")))
    files = o.selectExpr("dataset_id", "concat(code, '_', day, '.csv') as file_name")
    return site, files


def roster_files(spark, sf):
    """Roster rows to data files by exact name, respelled name, site code and region + date."""
    site, files = _roster(spark, sf)
    return I.resolve_by_steps(site, files).select("ord", "file_name", F.col("step").cast("int").alias("step"))


def source_tsp(spark, sf):
    o = V.table(spark, sf, "orders").selectExpr(*ROSTER_SPARK)
    roster = o.selectExpr(
        "ord", "concat(code, '_', day, '.csv') as filename", "concat(60 + o_custkey % 10, '.5') as latitude",
        "if(o_orderkey % 37 = 0, 'west', '-150.25') as longitude",
        "case o_orderkey % 3 when 0 then date_format(o_orderdate, 'MM/dd/yy') when 1 then date_format(o_orderdate, 'M/d/yyyy') else '' end as date",
        "if(o_orderkey % 5 = 0, '', code) as site_code", "'' as gtnp_id", "region as site_name",
    )
    day = V.table(spark, sf, "orders").selectExpr("o_orderkey as ok", "concat('US_R', o_custkey % 50, '_', o_orderkey, '_', date_format(o_orderdate, 'yyyy_MM_dd'), '.csv') as file_name")
    members = V.table(spark, sf, "lineitem").join(day, F.col("l_orderkey") == F.col("ok"), "right").selectExpr(
        "file_name", "cast(l_linenumber * 2 as string) as depth", "if(l_partkey % 9 = 0, '', cast(l_quantity - 40 as string)) as temperature",
        "l_partkey * 100000 + cast(l_extendedprice as int) % 100000 as ord",
    )
    return _flat(N.tsp(roster, members, _landing("tsp_north_america_ground_temperature")))


def date_parsing(spark, sf):
    o = V.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """case o_orderkey % 6 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'M/d/yyyy')
          when 2 then date_format(o_orderdate, 'yyyy') when 3 then concat(' ', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss"))
          when 4 then date_format(o_orderdate, 'MM/dd/yy') else o_orderpriority end as t""",
    )
    f = lambda fmt: F.date_format(P.parse_date(F.col("t"), fmt), "yyyy-MM-dd")
    return o.select("o_orderkey", f(P.ISO_US_OR_YEAR).alias("iso_us_year"), f(P.US_THEN_ISO).alias("us_iso"), f(P.ROSTER_DATE).alias("roster"))


def category_index(spark, sf):
    cats = ("HOUSEHOLD", "MACHINERY", "BUILDING")
    return V.table(spark, sf, "customer").select("c_custkey", P.category_index(F.col("c_mktsegment"), cats).alias("idx"))


def slugs(spark, sf):
    texts = V.table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")  # a table may be one row group
    return texts.select("doc_id", P.slug(F.col("text")).alias("slug"))


_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_NUM = "try_cast(trim({0}) as double)"

CENTROIDS_SQL = """plots as (
  select 'P' || (s_suppkey % 90) as plot_id, avg(7900000.0::double + s_suppkey * 3) as nn, avg(580000.0::double + s_suppkey * 7) as ee from supplier group by 1)"""


def _located_plots():
    return f"located as ({utm_sql('plots', 'ee', 'nn', 'plot_id', 12)})"


# --- whole documents as the lines of files ----------------------------------------------------


def _lines(spark, sf, content):
    """``file, file_name, split, ord, line`` of one file per document with the given content."""
    d = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("file"), F.expr(content).alias("content"))
    parts = d.select("file", F.col("file").alias("file_name"), F.lit(0).alias("split"), F.posexplode(F.split("content", "\n")).alias("ord", "line"))
    return parts.withColumn("ord", F.col("ord").cast("long"))


def comment_blocks(spark, sf):
    """Each document as a comment block before a table; no window on its length."""
    lines = _lines(spark, sf, "concat('/* ', replace(text, '*/', ''), '\\n*/\\nA\\tB\\n')")
    return D.comment_block(lines).select("file", F.md5("native_metadata").alias("digest"))


def block_starts(spark, sf):
    """First data line behind the comment block of each document."""
    lines = _lines(spark, sf, "concat('/* ', replace(text, '*/', ''), '\\n*/\\nA\\tB\\n')")
    return D._drop_comment_block(lines).filter("ord = start").select("file", "start", "line")


def csv_records(spark, sf):
    """Each document as a quoted field: its line breaks and quotes stay inside the record."""
    lines = _lines(spark, sf, """concat('id,text\\n', doc_id, ',"', replace(text, '"', '""'), '"\\n\\nlast,x')""")
    cells = D.with_cells(D.logical_records(lines).filter("record > 0"))
    return cells.select("file", "record", F.get("cells", F.lit(0)).alias("id"), F.md5(F.get("cells", F.lit(1))).alias("digest"))


def own_headers(spark, sf):
    """Columns by name in files of two layouts; the optional one is blank where a file lacks it."""
    lines = _lines(spark, sf, """if(doc_id % 2 = 0, concat('SiteName,File_Name\\n', source, ',', doc_id, '.csv'),
        concat('filename,x,Latitude\\n', doc_id, '.csv,"a,b",', doc_id % 90))""")
    rows = D.per_file_columns(lines, (0,), {"name": ("filename", "file_name"), "lat": ("latitude",), "site": ("sitename",)}, required=("name",))
    return rows.select("file", "ord", "name", "lat", "site")


QUERIES = {
    "comment_blocks": (comment_blocks, """
select cast(doc_id as varchar) as file, md5('/* ' || replace(text, '*/', '') || chr(10) || '*/') as digest from documents"""),
    "block_starts": (block_starts, """
select cast(doc_id as varchar) as file, cast(length(t) - length(replace(t, chr(10), '')) + 2 as bigint) as start, 'A' || chr(9) || 'B' as line
from (select doc_id, replace(text, '*/', '') as t from documents)"""),
    "csv_records": (csv_records, """
select cast(doc_id as varchar) as file, cast(1 as bigint) as record, cast(doc_id as varchar) as id, md5(text) as digest from documents
union all select cast(doc_id as varchar), 2, 'last', md5('x') from documents"""),
    "own_headers": (own_headers, """
select cast(doc_id as varchar) as file, cast(1 as bigint) as ord, doc_id || '.csv' as name, case when doc_id % 2 = 0 then '' else cast(doc_id % 90 as varchar) end as lat,
  case when doc_id % 2 = 0 then source else '' end as site from documents"""),
    "source_calm": (source_calm, V.with_ctes(_raw_sql(CALM_RAW), """typed as (
  select *, case when "Event label" = '' then "Event" else "Event label" end as ev, try_cast(trim("ALD [cm]") as double) as cm,
    try_cast("Latitude of event" as double) as lat, cast("Longitude of event" as double) as lon, "DATE/TIME" as d from raw)""", body=f"""
select 'calm_' || ev || '_' || d as obs_id, 'point' as obs_type, 'active_layer_thickness' as variable, round(cm * 0.01::double, 6) as value, 'm' as unit,
  lat as latitude, lon as longitude, 0.0::double as depth_m,
  {_TIME.format("case event_id % 4 when 0 then make_timestamp(cast(d as bigint), 1, 1, 0, 0, 0) when 3 then timestamp '2016-07-01 10:20:30' when 2 then timestamp '2015-08-03' else cast(d as timestamp) end")} as time_start,
  case when cm >= 150 then 'possible_probe_refusal' else '' end as qc_flags
from typed where cm is not null and lat is not null""")),
    "source_gtnp": (source_gtnp, V.with_ctes(_raw_sql(GTNP_RAW), """typed as (
  select *, case when "MAGT [°C]" <> '' then "MAGT [°C]" else "Temp [°C]" end as t, cast("Latitude" as double) as lat, cast("Longitude" as double) as lon,
    case when "DEPTH, sediment/rock [m]" <> '' then "DEPTH, sediment/rock [m]" else "Depth sed [m]" end as depth from raw)""", body=f"""
select 'gtnp_' || "Event" || '_' || trim("Name") || '_' || depth || 'm_' || "Date/Time" || '_' || printf('%.4f', lat) || '_' || printf('%.4f', lon) as obs_id,
  'profile' as obs_type, 'ground_temperature' as variable, round(try_cast(t as double), 6) as value, 'degC' as unit, lat as latitude, lon as longitude,
  try_cast(depth as double) as depth_m, {_TIME.format('make_timestamp(cast("Date/Time" as bigint), 1, 1, 0, 0, 0)')} as time_start, '' as qc_flags
from typed where try_cast(t as double) is not null""")),
    "source_above": (source_above, V.with_ctes(_raw_sql(ABOVE_RAW), """long as (
  select *, 'ALT' as col_name, "ALT" as v from raw union all select *, 'Soil Moisture', "Soil Moisture" from raw),
typed as (
  select *, try_cast(v as double) as x, case when try_cast("depth_top" as double) >= 0 then cast("depth_top" as double) end as top,
    case when try_cast("depth_bottom" as double) >= 0 then cast("depth_bottom" as double) end as bottom, try_cast("Depth_cm" as double) as single from long)""", body="""
select 'above_above_stdm_set_' || lpad(cast(ord as varchar), cast(greatest(6, length(cast(ord as varchar))) as integer), '0') || '_' || col_name as obs_id, 'point' as obs_type,
  case col_name when 'ALT' then 'active_layer_thickness' else 'volumetric_water_content' end as variable, round(x * 0.01::double, 6) as value,
  case col_name when 'ALT' then 'm' else '1' end as unit, cast("Latitude" as double) as latitude, cast("longitude" as double) as longitude,
  round(case when col_name = 'ALT' then null when top is not null and bottom is not null then (top + bottom) / 2.0::double / 100.0::double
    else coalesce(top / 100.0::double, single / 100.0::double) end, 6) as depth_m,
  case when event_id % 3 < 2 then '2012-08-03 00:00:00' end as time_start, '' as qc_flags
from typed where x >= 0""")),
    "unpivot_wide": (unpivot_wide, V.with_ctes(_raw_sql(ABOVE_RAW), body="""
select ord, 'ALT' as col_name, "ALT" as raw, 'active_layer_thickness' as variable from raw
union all select ord, 'Soil Moisture', "Soil Moisture", 'volumetric_water_content' from raw""")),
    "source_thaw": (source_thaw, """
select 'thawdb_' || lpad(cast(p_partkey as varchar), cast(greatest(5, length(cast(p_partkey as varchar))) as integer), '0') || '_' || printf('%.3f', 60.0::double + p_size % 9) || '_-150.500' as obs_id,
  'event' as obs_type, 'thaw_event_label' as variable, case when p_partkey % 11 < 9 then p_partkey % 11 else -1 end::double as value, 'category_index' as unit,
  60.0::double + p_size % 9 as latitude, -150.5::double as longitude, null::double as depth_m, null::varchar as time_start, '' as qc_flags
from part where p_partkey % 31 <> 5"""),
    "source_sloan_long": (source_sloan_long, V.with_ctes(CENTROIDS_SQL, _located_plots(), """rows as (
  select *, 'P' || l_suppkey as plot_id, date_trunc('day', l_shipdate) + to_hours(l_partkey % 24) + to_minutes(l_orderkey % 60) + interval 9 hours as utc from lineitem)""", body=f"""
select 'sloan_2014_barrow_soil_30min_' || plot_id || '_' || (l_linenumber * 5) || 'cm_' || strftime(utc, '%Y%m%dT%H%M%SZ') as obs_id, 'point' as obs_type,
  'soil_temperature' as variable, round(l_quantity - 30, 6) as value, 'degC' as unit, round(lat, 6) as latitude, round(lon, 6) as longitude,
  round(l_linenumber * 5 / 100.0::double, 6) as depth_m, {_TIME.format("utc")} as time_start, '' as qc_flags
from rows join located using (plot_id) where l_partkey % 13 <> 0 and l_partkey % 17 <> 0 and l_partkey % 19 <> 0 and l_linenumber <> 9""")),
    "source_sloan_plots": (source_sloan_plots, V.with_ctes(CENTROIDS_SQL, _located_plots(), """rows as (
  select *, 'P' || (o_custkey % 120) as plot_id, 5 * (1 + o_custkey % 3) as cm,
    date_trunc('day', o_orderdate) + to_hours(o_orderkey % 24) + interval 30 minutes + interval 8 hours as utc from orders)""", body=f"""
select 'sloan_2014_barrow_soil_perplot_' || plot_id || '_' || cm || 'cm_' || strftime(utc, '%Y%m%dT%H%M%SZ') as obs_id, 'point' as obs_type,
  'soil_temperature' as variable, round(o_totalprice / 1000, 6) as value, 'degC' as unit, round(lat, 6) as latitude, round(lon, 6) as longitude,
  round(cm / 100.0::double, 6) as depth_m, {_TIME.format("utc")} as time_start, '' as qc_flags
from rows join located using (plot_id) where o_orderkey % 23 <> 0""")),
    "source_kanevskiy": (source_kanevskiy, V.with_ctes("""rows as (
  select *, case o_orderkey % 4 when 0 then (o_custkey % 90 + o_custkey % 90 + 11) / 2.0::double when 1 then null else (o_custkey % 300)::double end as cm,
    case when o_orderkey % 6 = 0 then null when o_orderkey % 6 = 1 then 0 else o_orderkey % 100 end::double as eic,
    70.25::double + o_custkey % 3 as lat, -150.5::double - o_custkey % 4 as lon from orders),
made as (
  select *, 'kanevskiy_BH_' || (o_custkey % 70) || '_B_' || printf('%.4f', lat) || '_' || printf('%.4f', lon) || '_' || cast(round_even(cm, 0) as bigint) || 'cm_' || strftime(o_orderdate, '%Y%m%d') as obs_id
  from rows where eic is not null and cm is not null and o_orderkey % 29 <> 0)""", body=f"""
select obs_id, 'profile' as obs_type, 'excess_ice_content' as variable, round(eic / 100.0::double, 6) as value, '1' as unit, lat as latitude, lon as longitude,
  round(cm / 100.0::double, 6) as depth_m, {_TIME.format("date_trunc('day', o_orderdate)")} as time_start, '' as qc_flags
from made qualify row_number() over (partition by obs_id order by o_custkey % 5, o_orderkey) = 1""")),
    "roster_files": (roster_files, V.with_ctes("""o as (
  select 'set_' || (o_orderkey % 20) as dataset_id, o_orderkey as ord, 'US_R' || (o_custkey % 50) as region, 'US_R' || (o_custkey % 50) || '_' || o_orderkey as code,
    strftime(o_orderdate, '%Y_%m_%d') as day, o_orderkey from orders),
site as (select dataset_id, ord, region, """ + _FILENAME.format(c="code") + """ as filename,
    case when o_orderkey % 4 = 3 then region || '_x' || o_orderkey else code end as site_code from o),
wanted as (select *, replace(filename, '-', '_') || case when ends_with(lower(filename), '.csv') then '' else '.csv' end as normal,
    replace(regexp_extract(filename, '(\\d{4}[_-]\\d{2}[_-]\\d{2})', 1), '-', '_') as tok from site),
files as (select distinct dataset_id, code || '_' || day || '.csv' as f from o),
s3 as (select w.ord, min(f) as f3 from wanted w join files x on x.dataset_id = w.dataset_id and starts_with(f, site_code) group by w.ord having count(*) = 1),
s4 as (select w.ord, min(f) as f4 from wanted w join files x on x.dataset_id = w.dataset_id and starts_with(f, region) and contains(f, tok) group by w.ord having count(*) = 1)""", body="""
select ord, coalesce(a.f, b.f, f3, f4) as file_name, cast(case when a.f is not null then 1 when b.f is not null then 2 when f3 is not null then 3 else 4 end as integer) as step
from wanted w left join files a on a.dataset_id = w.dataset_id and a.f = filename left join files b on b.dataset_id = w.dataset_id and b.f = normal
left join s3 using (ord) left join s4 using (ord) where coalesce(a.f, b.f, f3, f4) is not null""")),
    "source_tsp": (source_tsp, V.with_ctes("""rows as (
  select l.*, o_custkey, o_orderdate, 'US_R' || (o_custkey % 50) || '_' || o_orderkey as code, strftime(o_orderdate, '%Y_%m_%d') as day, o_orderkey
  from lineitem l join orders on l_orderkey = o_orderkey where o_orderkey % 37 <> 0),
made as (
  select *, 'tsp_' || case when o_orderkey % 5 = 0 then code || '_' || day else code end || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || (l_linenumber * 200) || 'cm' as obs_id
  from rows where l_partkey % 9 <> 0)""", body=f"""
select obs_id, 'profile' as obs_type, 'ground_temperature' as variable, round(l_quantity - 40, 6) as value, 'degC' as unit,
  60.5::double + o_custkey % 10 as latitude, -150.25::double as longitude, (l_linenumber * 2)::double as depth_m,
  {_TIME.format("date_trunc('day', o_orderdate)")} as time_start, '' as qc_flags
from made qualify row_number() over (partition by obs_id order by o_orderkey, l_partkey * 100000 + cast(trunc(l_extendedprice) as bigint) % 100000) = 1""")),
    "date_parsing": (date_parsing, """
with d as (select o_orderkey, o_orderkey % 6 as m, strftime(o_orderdate, '%Y-%m-%d') as full_date, strftime(o_orderdate, '%Y-01-01') as y from orders)
select o_orderkey, case when m in (0, 1, 3) then full_date when m = 2 then y end as iso_us_year,
  case when m in (0, 1, 4) then full_date end as us_iso, case when m in (0, 1, 4) then full_date end as roster from d"""),
    "category_index": (category_index, """
select c_custkey, coalesce(list_position(['HOUSEHOLD', 'MACHINERY', 'BUILDING'], c_mktsegment) - 1, -1)::double as idx from customer"""),
    "slugs": (slugs, """
select doc_id, coalesce(nullif(trim(regexp_replace(text, '[^A-Za-z0-9]+', '_', 'g'), '_'), ''), 'unknown') as slug from documents"""),
}
