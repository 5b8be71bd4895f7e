"""Observation, series, file, paper, polygon and raster tables derived from the given ones.

Every view exists twice: as DataFrame code over the Parquet tables and as SQL text
over the same tables, used as common table expressions by the check queries.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.schema import OBSERVATION_SCHEMA, PAPER_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _d(x: float):
    return F.lit(float(x))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as observations of five variables, three sources and five datasets."""
    e = table(spark, sf_dir, "events").selectExpr("*", r"cast(regexp_extract(props, '(\\d+)', 1) as int) as k")
    return e.selectExpr(
        "concat('ev_', event_id) as obs_id",
        "concat('ds_', event_id % 5) as dataset_id",
        "if(event_type = 'view', 'event', 'point') as obs_type",
        """case event_type when 'click' then 'active_layer_thickness' when 'error' then 'ground_temperature'
          when 'purchase' then 'volumetric_water_content' when 'signup' then 'snow_depth'
          when 'view' then 'thaw_event_label' end as variable""",
        """case when event_type = 'error' and event_id % 2 = 1 then value + 200
          when event_type = 'error' then value - 60 else value end as value""",
        """case when event_id % 97 = 0 then 'furlong' when event_type = 'error' and event_id % 2 = 1 then 'K'
          when event_type = 'click' then 'cm' when event_type = 'error' then 'degC'
          when event_type = 'purchase' then 'percent' when event_type = 'signup' then 'mm'
          when event_type = 'view' then 'category_index' end as unit""",
        "60D + (user_id * 37 % 100) / 10D + (event_id % 7) * 0.004D as latitude",
        "-165D + (user_id * 53 % 300) / 10D + (event_id % 11) * 0.006D as longitude",
        "case when k % 4 = 0 then null when k = 13 then -1D else k / 50D end as depth_m",
        "cast(if(k % 10 <> 9, ts, null) as timestamp) as time_start",
        "cast(if(k % 10 <> 9, ts, null) as timestamp) as time_end",
        "cast(array() as array<string>) as qc_flags",
        f"cast(named_struct('source_id', concat('src_', event_id % 3), {_NO_PROVENANCE}) as {_PROVENANCE}) as provenance",
        "map('k', cast(k as string)) as extra",
        "event_id as ord",
    )


_PROVENANCE = OBSERVATION_SCHEMA["provenance"].dataType.simpleString()
_NO_PROVENANCE = ", ".join(
    f"'{f.name}', null" for f in OBSERVATION_SCHEMA["provenance"].dataType.fields if f.name != "source_id"
)

OBS_SQL = """obs as (
  select 'ev_' || event_id as obs_id, 'ds_' || (event_id % 5) as dataset_id,
    'src_' || (event_id % 3) as source_id,
    case when event_type = 'view' then 'event' else 'point' end as obs_type,
    case event_type when 'click' then 'active_layer_thickness' when 'error' then 'ground_temperature'
      when 'purchase' then 'volumetric_water_content' when 'signup' then 'snow_depth'
      when 'view' then 'thaw_event_label' end as variable,
    case when event_type = 'error' and event_id % 2 = 1 then value + 200
      when event_type = 'error' then value - 60 else value end as value,
    case when event_id % 97 = 0 then 'furlong'
      when event_type = 'error' and event_id % 2 = 1 then 'K'
      when event_type = 'click' then 'cm' when event_type = 'error' then 'degC'
      when event_type = 'purchase' then 'percent' when event_type = 'signup' then 'mm'
      when event_type = 'view' then 'category_index' end as unit,
    cast(60 as double) + (user_id * 37 % 100) / cast(10 as double) + (event_id % 7) * cast(0.004 as double) as latitude,
    cast(-165 as double) + (user_id * 53 % 300) / cast(10 as double) + (event_id % 11) * cast(0.006 as double) as longitude,
    case when k % 4 = 0 then null when k = 13 then cast(-1 as double) else k / cast(50 as double) end as depth_m,
    case when k % 10 <> 9 then ts end as time_start, k, event_id as ord
  from (select *, cast(regexp_extract(props, '(\\d+)', 1) as integer) as k from events)
)"""

CANONICAL_SQL = """unit_of(variable, target) as (values
    ('active_layer_thickness','m'),('soil_temperature','degC'),('ground_temperature','degC'),
    ('volumetric_ice_content','1'),('excess_ice_content','1'),('volumetric_water_content','1'),
    ('ndvi','1'),('elevation','m'),('snow_depth','m'),('land_surface_temperature','degC'),
    ('surface_deformation','mm'),('precipitation','mm/day'),('air_temperature','degC')),
conversion(src, dst, scale, shift) as (values
    ('cm','m',cast(0.01 as double),cast(0 as double)),('mm','m',0.001,0),('m','cm',100,0),('m','mm',1000,0),
    ('K','degC',1,-273.15),('degC','K',1,273.15),('%','1',0.01,0),('1','%',100,0)),
spelled as (
  select o.*, u.target, case lower(trim(unit)) when 'fraction' then '1' when 'dimensionless' then '1'
      when 'percent' then '%' when 'deg_c' then 'degC' when 'degc' then 'degC'
      when 'celsius' then 'degC' when 'degree_celsius' then 'degC' else trim(unit) end as u
  from obs o left join unit_of u using (variable)),
canon as (
  select s.obs_id, s.dataset_id, s.source_id, s.obs_type, s.variable,
    case when target is null or u = target then s.value
      when c.scale is not null then s.value * c.scale + c.shift else s.value end as value,
    case when target is not null and (u = target or c.scale is not null) then target else s.unit end as unit,
    s.latitude, s.longitude, s.depth_m, s.time_start, s.k, s.ord, s.target
  from spelled s left join conversion c on c.src = s.u and c.dst = s.target)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as multi-year series: group columns, time, value and order."""
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag",
        F.col("l_shipdate").cast("timestamp").alias("time_start"),
        F.col("l_quantity").alias("value"),
        F.lit("point").alias("obs_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        F.col("l_partkey").alias("tie"), F.col("l_extendedprice").alias("tie2"),
    )


_PATH = """case when doc_id % 97 = 5 then 'README.md' when doc_id % 97 = 6 then '.' || doc_id
      when doc_id % 200 = 7 then 'bagit.txt' when doc_id % 200 = 11 then 'root_dd.csv'
      else lang || '/' || (case
        when doc_id % 40 = 0 then 'site' || (doc_id {div} 40 % 5) || '_dd'
        when doc_id % 40 = 10 then doc_id || '_flmd'
        when doc_id % 10 = 0 then 'site' || (doc_id {div} 40 % 5) || '_' || doc_id
        when doc_id % 40 = 13 then 'science-metadata-' || doc_id
        when doc_id % 40 = 22 then doc_id || '_user_file'
        else cast(doc_id as {text}) end) || '.' ||
        (case doc_id % 10 when 0 then 'csv' when 1 then 'tsv' when 2 then 'pdf' when 3 then 'xml' when 4 then 'nc'
          when 5 then 'tif' when 6 then 'txt' when 7 then 'json' when 8 then 'md' else 'bin' end) end"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as package files, two hundred per package and source at most.

    Content is the whole text; the declared md5 is sometimes wrong.
    """
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "source as source_id", "source || '_' || (doc_id div 200) as dataset_id",
        _PATH.format(div="div", text="string") + " as relative_path",
        "text as content",
        "if(doc_id % 20 = 0, repeat('0', 32), upper(md5(text))) as declared_md5",
    )


FILES_SQL = f"""files as (
  select doc_id, source as source_id, source || '_' || (doc_id // 200) as dataset_id,
    {_PATH.format(div="//", text="varchar")} as relative_path, text as content,
    case when doc_id % 20 = 0 then repeat('0', 32) else upper(md5(text)) end as declared_md5
  from documents)"""


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as theme search results: same text = same paper."""
    d = table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    h = F.md5("text")
    doi = F.when(F.substring(h, 1, 1) < "c", F.concat(F.lit("10.1234/"), F.substring(h, 1, 8)))
    shaped = d.select(
        F.coalesce(doi, h).alias("paper_id"), doi.alias("doi"),
        F.when(n % 7 == 0, F.lit("")).otherwise(F.col("text")).alias("title"),
        F.when(n % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("Author "), (n % 50).cast("string")))).alias("authors"),
        F.when(n % 6 != 0, (F.lit(1980) + n % 45)).cast("int").alias("year"),
        F.when(n % 4 != 0, F.concat(F.lit("Journal "), (n % 9).cast("string"))).alias("venue"),
        F.when(n % 11 != 0, F.col("text")).alias("abstract"),
        F.lit(None).cast("string").alias("source_url"),
        (n % 30).cast("int").alias("citation_count"),
        F.lit("snapshot").alias("source_backend"), F.lit(False).alias("verified"),
        F.lit(None).cast("map<string,string>").alias("extra"),
        F.col("source").alias("theme"), n.alias("ord"),
    )
    return shaped.select(*PAPER_SCHEMA.names, "theme", "ord")


PAPERS_SQL = """papers as (
  select coalesce(doi, h) as paper_id, doi,
    case when n % 7 = 0 then '' else text end as title,
    case when n % 5 = 0 then '' else 'Author ' || (n % 50) end as authors,
    cast(case when n % 6 <> 0 then 1980 + n % 45 end as integer) as year,
    case when n % 4 <> 0 then 'Journal ' || (n % 9) end as venue,
    case when n % 11 <> 0 then text end as abstract,
    cast(n % 30 as integer) as citation_count, source as theme, n as ord, h
  from (select *, doc_id as n, md5(text) as h,
    case when substr(md5(text), 1, 1) < 'c' then '10.1234/' || substr(md5(text), 1, 8) end as doi from documents)
)"""


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as quadrilaterals on a 20 x 20 km grid, painted in key order."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x0 = (k * 7919 % 17000) + _d(13.7)
    y0 = (k * 104729 % 17000) + _d(31.9)
    w = (k * 31 % 2900) + _d(301.3)
    h = (k * 57 % 2700) + _d(407.7)
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(
        p(x0, y0), p(x0 + w, y0 + h / _d(8)), p(x0 + w * _d(0.83), y0 + h), p(x0 - w / _d(9), y0 + h * _d(0.71)),
    )
    return s.select(
        k.alias("ord"), ring.alias("ring"), F.col("s_acctbal").alias("value"),
        F.col("s_nationkey").alias("category"),
    )


POLYGONS_SQL = """corners as (
  select s_suppkey as ord, s_acctbal as value, s_nationkey as category,
    (s_suppkey * 7919 % 17000) + cast(13.7 as double) as x0, (s_suppkey * 104729 % 17000) + cast(31.9 as double) as y0,
    (s_suppkey * 31 % 2900) + cast(301.3 as double) as w, (s_suppkey * 57 % 2700) + cast(407.7 as double) as h
  from supplier),
edges as (
  select ord, value, category, x0 as ax, y0 as ay, x0 + w as bx, y0 + h / cast(8 as double) as by_ from corners
  union all select ord, value, category, x0 + w, y0 + h / cast(8 as double), x0 + w * cast(0.83 as double), y0 + h from corners
  union all select ord, value, category, x0 + w * cast(0.83 as double), y0 + h, x0 - w / cast(9 as double), y0 + h * cast(0.71 as double) from corners
  union all select ord, value, category, x0 - w / cast(9 as double), y0 + h * cast(0.71 as double), x0, y0 from corners),
lattice as (
  select r.range as fr, c.range as fc, (c.range + 0.5) * cast(200 as double) as px, cast(20000 as double) - (r.range + 0.5) * cast(200 as double) as py
  from range(100) r, range(100) c),
covered as (
  select e.ord, e.value, e.category, l.fr, l.fc
  from edges e join lattice l on (e.ay <= l.py) <> (e.by_ <= l.py)
    and l.px < e.ax + (l.py - e.ay) * ((e.bx - e.ax) / (e.by_ - e.ay))
  group by all having count(*) % 2 = 1)"""


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a raster fifty pixels wide."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.floor(k / 50).alias("row"), (k % 50).alias("col"), F.col("p_retailprice").alias("value")
    )


RASTER_SQL = """raster as (
  select p_partkey // 50 as row, p_partkey % 50 as col, p_retailprice as value from part)"""


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as dataset metadata: box, period, licence, text; some fields missing."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    west = _d(-170) + (k * 13 % 400) / _d(10)
    south = _d(55) + (k * 7 % 180) / _d(10)
    year = lambda m, o: (F.lit(o) + k * m % 25).cast("int").cast("string")
    return c.select(
        F.concat(F.lit("doi:10.5555/"), k.cast("string")).alias("record_id"),
        F.concat(F.lit("set_"), k.cast("string")).alias("dataset_id"),
        F.concat(F.lit("src_"), F.col("c_nationkey").cast("string")).alias("source_id"),
        F.when(k % 9 != 0, F.col("c_name")).alias("name"),
        F.concat_ws(" ", "c_mktsegment", F.lit("Soil Temperature survey"), "c_name").alias("text"),
        F.when(k % 10 != 0, west).alias("west"), F.when(k % 10 != 0, south).alias("south"),
        F.when(k % 10 != 0, west + (k % 50) / _d(10)).alias("east"),
        F.when(k % 10 != 0, south + (k % 30) / _d(10)).alias("north"),
        F.when(k % 8 != 0, F.concat(year(3, 1990), F.lit("-03-01"))).alias("begin_date"),
        F.when(k % 8 != 0, F.concat(year(3, 1993), F.lit("-09-30"))).alias("end_date"),
        F.when(k % 12 == 0, F.lit("newer")).alias("superseded_by"),
        F.when(k % 5 != 0, F.lit("CC-BY-4.0")).alias("license"),
        F.concat(F.lit("https://doi.org/10.5555/"), k.cast("string")).alias("url"),
        k.alias("rank"),
    )


METADATA_SQL = """boxes as (
  select *, c_custkey as k, cast(-170 as double) + (c_custkey * 13 % 400) / cast(10 as double) as w0,
    cast(55 as double) + (c_custkey * 7 % 180) / cast(10 as double) as s0 from customer),
meta as (
  select 'doi:10.5555/' || k as record_id, 'set_' || k as dataset_id, 'src_' || c_nationkey as source_id,
    case when k % 9 <> 0 then c_name end as name,
    c_mktsegment || ' Soil Temperature survey ' || c_name as text,
    case when k % 10 <> 0 then w0 end as west, case when k % 10 <> 0 then s0 end as south,
    case when k % 10 <> 0 then w0 + (k % 50) / cast(10 as double) end as east,
    case when k % 10 <> 0 then s0 + (k % 30) / cast(10 as double) end as north,
    case when k % 8 <> 0 then (1990 + k * 3 % 25) || '-03-01' end as begin_date,
    case when k % 8 <> 0 then (1993 + k * 3 % 25) || '-09-30' end as end_date,
    case when k % 12 = 0 then 'newer' end as superseded_by,
    case when k % 5 <> 0 then 'CC-BY-4.0' end as license, 'https://doi.org/10.5555/' || k as url, k as rank
  from boxes)"""


# --- fixed values: variables the derived sources declare --------------------------------
SERVED = ("active_layer_thickness", "soil_temperature", "ground_temperature", "snow_depth", "ndvi")


def capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier by nation: every supplier adds one variable to its nation's source."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("src_"), F.col("s_nationkey").cast("string")).alias("source_id"),
        F.get(F.array(*[F.lit(v) for v in SERVED]), (F.col("s_suppkey") % 5).cast("int")).alias("variable"),
    ).distinct()


CAPABILITIES_SQL = """caps as (
  select distinct 'src_' || s_nationkey as source_id,
    case s_suppkey % 5 when 0 then 'active_layer_thickness' when 1 then 'soil_temperature'
      when 2 then 'ground_temperature' when 3 then 'snow_depth' when 4 then 'ndvi' end as variable
  from supplier)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body
