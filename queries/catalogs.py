"""Package index, catalog tables and reports, discovery."""

import uuid

from pyspark.sql import functions as F

from cairn.functions.text import download_id, missing_sentinel
from cairn.operators import catalog as K
from cairn.operators import discover as D
from cairn.operators import index as I
from cairn.operators import requests as Q
from cairn.plans.acquire import index_packages
from cairn.session import shared_dir
from cairn.sources.files import write_files
from cairn.sources.package import manifest_lines
from cairn.sources.sinks import analysis_ready, provenance_records
from queries import views as V
from queries.checks import CANON, canon, r6

# --- package index ----------------------------------------------------------------------

INDEX_SQL = """named as (select *, regexp_extract(relative_path, '([^/]*)$', 1) as name from files),
indexed as (
  select substr(sha256(dataset_id || '|' || relative_path), 1, 16) as file_id, dataset_id, source_id, relative_path,
    case when lower(name) in ('bagit.txt', 'bag-info.txt', 'manifest-md5.txt', 'tagmanifest-md5.txt') then 'bagit'
      when lower(name) = 'flmd.csv' or lower(name) like '%\\_flmd.csv' escape '\\' then 'flmd'
      when lower(name) like '%\\_dd.csv' escape '\\' then 'dictionary'
      when lower(name) like '%science-metadata%' and lower(name) like '%.xml' then 'eml'
      when lower(name) like '%.xml' then 'metadata'
      when lower(name) like '%user\\_file%' escape '\\' and lower(name) like '%.pdf' then 'readme'
      when lower(name) like '%.pdf' then 'aux'
      when regexp_matches(lower(name), '\\.(csv|tsv|nc|tif|tiff)$') then 'data' else 'aux' end as role,
    case regexp_extract(lower(name), '(\\.[^.]+)$', 1) when '.csv' then 'csv' when '.tsv' then 'tsv' when '.pdf' then 'pdf'
      when '.xml' then 'xml' when '.nc' then 'netcdf' when '.tif' then 'geotiff' when '.tiff' then 'geotiff'
      when '.txt' then 'text' when '.json' then 'json' when '.md' then 'markdown' end as format,
    cast(strlen(content) as bigint) as bytes, sha256(content) as content_checksum, md5(content) as md5, declared_md5, doc_id, name
  from named
  where relative_path not in ('PROVENANCE.json', 'CITATION.cff', 'README.md', 'metadata.txt', 'metadata.json')
    and not starts_with(name, '.'))"""
INDEX = (V.FILES_SQL, INDEX_SQL)


def file_index(spark, sf):
    return I.index_files(V.files(spark, sf))


def package_standard(spark, sf):
    return I.detect_standard(V.files(spark, sf))


def manifest_mismatch(spark, sf):
    f = V.files(spark, sf)
    lines = f.select("dataset_id", F.concat_ws("  ", "declared_md5", "relative_path").alias("line"))
    return I.manifest_mismatches(I.index_files(f), manifest_lines(lines)).select(
        "dataset_id", "relative_path", "declared_md5"
    ).distinct()


def package_fingerprint(spark, sf):
    return I.package_fingerprint(I.index_files(V.files(spark, sf)))


# a folder of packages of both standards, one per supplier; the text is SQL on Spark and DuckDB alike
_EML = ("'<eml><dataTable><entityName>S ' || k || '.csv</entityName><attributeList><attribute><attributeName>EIC, %</attributeName>"
        "<measurementScale><ratio><unit><standardUnit>percent</standardUnit></unit></ratio></measurementScale>"
        "<missingValueCode><code>-99</code></missingValueCode></attribute><attribute><attributeName>Remark ' || k % 7 || '</attributeName>"
        "</attribute></attributeList></dataTable></eml>'")
PACKAGES_SQL = f"""with s as (select s_suppkey as k, 'set_' || s_suppkey as d, 'a,b' || chr(10) || '1,' || s_name || chr(10) as body from supplier)
select d as dataset_id, 'T_' || k || '_2020.csv' as relative_path, body as content from s where k % 2 = 0
union all select d, 'T_' || k || '_dd.csv', 'Column_or_Row_Name,Unit,Definition' || chr(10) || 'soil_temperature_5cm,degC,missing values = -' || k || chr(10)
  || 'site' || k % 5 || ',N/A,Name' || chr(10) from s where k % 2 = 0
union all select d, 'README.md', 'generated' from s where k % 2 = 0
union all select d, 'bagit.txt', 'BagIt' from s where k % 2 = 1
union all select d, 'data/S_' || k || '.csv', body from s where k % 2 = 1
union all select d, 'metadata/science-metadata.xml', {_EML} from s where k % 2 = 1
union all select d, 'manifest-md5.txt', case when k % 3 = 0 then md5('other') else md5(body) end || '  data/S_' || k || '.csv' || chr(10) from s where k % 2 = 1"""


def _folder(spark, sf):
    """The packages written below a shared folder, and their index."""
    spread = 4 * spark.sparkContext.defaultParallelism  # a table may be one row group
    V.table(spark, sf, "supplier").repartition(spread, "s_suppkey").createOrReplaceTempView("supplier")
    root = f"{shared_dir(spark).rstrip('/')}/packages-{uuid.uuid4().hex}"
    files = spark.sql(PACKAGES_SQL)
    write_files(files.select(F.concat_ws("/", "dataset_id", "relative_path").alias("path"), "content"), root)
    return index_packages(spark, root)


def folder_files(spark, sf):
    idx = _folder(spark, sf)
    return idx.files.join(idx.standard, "dataset_id").select(
        "dataset_id", "relative_path", "role", "format", "bytes", "content_checksum", "md5", "missing_sentinel", "standard")


def folder_variables(spark, sf):
    return _folder(spark, sf).variables


def folder_mismatches(spark, sf):
    return _folder(spark, sf).mismatches.select("dataset_id", "relative_path", "declared_md5")


def dictionary_match(spark, sf):
    return I.match_dictionary_files(V.files(spark, sf)).distinct()


def entity_match(spark, sf):
    """Declared entity names: exact, respelled, and absent ones."""
    n = F.col("doc_id")
    name = I.base_name(F.col("relative_path"))
    entity = (
        F.when(n % 3 == 0, name).when(n % 3 == 1, F.upper(F.regexp_replace(name, "_", " - ")))
        .otherwise(F.concat(name, F.lit(".gone")))
    )
    f = V.files(spark, sf)
    return I.match_entities(f.select("dataset_id", entity.alias("entity"), "doc_id"), f).select("doc_id", "entity", "target_path")


def sentinel_text(spark, sf):
    n = F.col("doc_id")
    text = F.concat("text", F.when(n % 3 == 0, F.lit(" Missing Values = '-9999'. Rest.")).when(n % 3 == 1, F.lit(" missing values = none given\nnext")).otherwise(F.lit("")))
    return V.table(spark, sf, "documents").select("doc_id", missing_sentinel(text).alias("sentinel"))


_RAW = """case event_type when 'click' then 'Soil_Temperature_' || (event_id % 4) || 'cm' when 'error' then 'EIC, %'
      when 'purchase' then case when event_id % 2 = 0 then 'Soil Moisture (v/v)' else 'VMC, %' end
      when 'signup' then 'Snow-Depth [m]' else 'Notes ' || (event_id % 3) end"""
_UNIT = "case event_id % 4 when 0 then 'percent' when 1 then 'degC' when 2 then '' end"
_MISSING = "case event_id % 5 when 0 then '-9999' when 1 then 'not_determined' end"


def _declared(spark, sf):
    """events as declared columns of data files, one file per user."""
    return V.table(spark, sf, "events").selectExpr(
        "concat('pkg_', user_id % 20) as dataset_id", "concat('file_', user_id) as file_id",
        f"{_RAW} as raw_name", f"{_UNIT} as unit", f"{_MISSING} as missing_sentinel", "event_id as ord",
    )


DECLARED_SQL = f"""declared as (
  select 'pkg_' || (user_id % 20) as dataset_id, 'file_' || user_id as file_id, {_RAW} as raw_name, {_UNIT} as unit,
    {_MISSING} as missing_sentinel, event_id as ord from events),
keyed as (
  select *, case when raw_name like 'Soil\\_Temp%' escape '\\' then 'soil_temperature' when raw_name like 'EIC%' then 'excess_ice_content'
      when raw_name like 'Soil Moisture%' or raw_name like 'VMC%' then 'volumetric_water_content'
      when raw_name like 'Snow%' then 'snow_depth' end as mapped, coalesce(mapped, raw_name) as variable from declared)"""


def variable_rows(spark, sf):
    return I.collapse_variables(_declared(spark, sf), "pdf")


def file_sentinels(spark, sf):
    return I.file_sentinels(_declared(spark, sf))


def variable_mapping(spark, sf):
    d = _declared(spark, sf)
    return d.select("ord", "raw_name", I.map_variable(F.col("raw_name")).alias("variable"))


# --- catalog reports ----------------------------------------------------------------------


def _datasets(spark, sf):
    f = V.files(spark, sf).select("dataset_id", "source_id").distinct()
    empty = V.table(spark, sf, "nation").select(
        F.concat(F.lit("empty_"), "n_name").alias("dataset_id"), F.lit("none").alias("source_id")
    )
    return f.unionByName(empty).withColumn("name", F.concat(F.lit("Package "), "dataset_id"))


_NAMES = ("soil_temperature", "ndvi", "elevation", "Site notes", "snow_depth")


def _variables(spark, sf):
    n = (F.col("doc_id") % 5).cast("int")
    return V.files(spark, sf).select(
        "dataset_id", F.get(F.array(*[F.lit(v) for v in _NAMES]), n).alias("variable"),
        I.file_id(F.col("dataset_id"), F.col("relative_path")).alias("file_id"),
        F.when(n != 1, F.lit("degC")).alias("unit"), F.when(n == 0, F.lit("0-1 m")).alias("depth_range"),
        (n != 3).alias("parseable"),
    )


REPORT_SQL = """sets as (
  select *, 'Package ' || dataset_id as name from (
    select distinct dataset_id, source_id from files union all select 'empty_' || n_name, 'none' from nation)),
vars as (
  select dataset_id, case doc_id % 5 when 0 then 'soil_temperature' when 1 then 'ndvi' when 2 then 'elevation'
      when 3 then 'Site notes' else 'snow_depth' end as variable,
    substr(sha256(dataset_id || '|' || relative_path), 1, 16) as file_id,
    case when doc_id % 5 <> 1 then 'degC' end as unit, case when doc_id % 5 = 0 then '0-1 m' end as depth_range, doc_id % 5 <> 3 as parseable
  from files)"""
REPORT = (*INDEX, REPORT_SQL)


def catalog_query(spark, sf):
    hits = K.variable_hits(_variables(spark, sf), I.index_files(V.files(spark, sf)), _datasets(spark, sf), "soil_temperature")
    return K.query_report(hits)


def catalog_inspect(spark, sf):
    return K.inspect_report(_datasets(spark, sf), I.index_files(V.files(spark, sf)), _variables(spark, sf))


def catalog_totals(spark, sf):
    downloads = V.table(spark, sf, "region")
    return K.totals(
        _datasets(spark, sf), downloads, I.index_files(V.files(spark, sf)), _variables(spark, sf), V.table(spark, sf, "events")
    )


def variable_breakdown(spark, sf):
    return K.variable_breakdown(_variables(spark, sf))


# --- catalog writes -----------------------------------------------------------------------


def upsert(spark, sf):
    old = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    new = V.table(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).alias("id"), F.col("o_orderstatus").alias("name"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("ord"),
    )
    return K.upsert(old, new, ["id"], ["ord"])


def _orders_as_obs(spark, sf, dataset, prefix):
    o = V.table(spark, sf, "orders")
    return o.selectExpr(
        f"concat('{prefix}', o_orderkey) as obs_id", f"{dataset} as dataset_id", "'point' as obs_type",
        "'snow_depth' as variable", "o_totalprice as value", "'mm' as unit", "60D as latitude", "-150D as longitude",
        "cast(null as double) as depth_m", "cast(o_orderdate as timestamp) as time_start",
        "cast(o_orderdate as timestamp) as time_end", "array(o_orderstatus, 'x') as qc_flags",
        "cast(map() as map<string,string>) as extra", "o_orderkey as ord",
    )


def _stored(df):
    return df.select(
        "obs_id", "dataset_id", "variable", r6("value").alias("value"), "unit", "depth_m",
        F.date_format("time_start", "yyyy-MM-dd HH:mm:ss").alias("time_start"), "qc_flags", "extra",
    )


def stored_observations(spark, sf):
    """Catalog form of observations whose ids repeat: the last row per id."""
    o = V.obs(spark, sf).withColumn("obs_id", F.concat(F.lit("o"), F.floor(F.col("ord") / 3).cast("string")))
    return _stored(K.stored_form(o))


def replace_dataset(spark, sf):
    stored = K.stored_form(V.obs(spark, sf))
    new = K.stored_form(_orders_as_obs(spark, sf, "concat('ds_', o_custkey % 2)", "or_"))
    return _stored(K.replace_datasets(stored, new))


def duplicate_ids(spark, sf):
    a = K.stored_form(V.obs(spark, sf))
    b = K.stored_form(_orders_as_obs(spark, sf, "concat('ds_', o_orderkey % 5)", "ev_").withColumn("dataset_id", F.lit("ds_0")))
    return K.duplicate_ids_across_datasets(a.unionByName(b))


def download_ids(spark, sf):
    f = I.index_files(V.files(spark, sf))
    return f.select("file_id", download_id(F.col("dataset_id"), F.col("content_checksum")).alias("download_id")).distinct()


def provenance_record(spark, sf):
    """Metadata and downloads to provenance JSON, read back field by field."""
    info = V.metadata(spark, sf).selectExpr(
        "dataset_id", "name", "url", "license", "text as description", "text || ' doi.org/10.1/x y' as citation",
    ).filter("name is not null")
    c = V.table(spark, sf, "customer").selectExpr(
        "concat('set_', c_custkey) as dataset_id", "concat('src_', c_nationkey) as source_id", "'center' as data_center",
        "concat('https://x.org/', c_custkey) as source_url", "timestamp '2024-01-02 03:04:05' as access_timestamp",
        "md5(c_name) as content_checksum", "c_custkey as bytes", "array(c_name) as files",
    )
    j = lambda k: F.get_json_object("record", f"$.{k}").alias(k)
    return provenance_records(info, c).select(
        "dataset_id", j("source_id"), j("landing_page"), j("doi"), j("title"), j("description"), j("license"),
        j("access_timestamp"), j("content_checksum_sha256"), j("bytes_downloaded"),
    )


def analysis_table(spark, sf):
    a = analysis_ready(canon(spark, sf))
    return a.select(
        "obs_id", "source_id", "dataset_id", "variable", r6("value").alias("value"), "unit",
        F.date_format("time_end", "yyyy-MM-dd HH:mm:ss").alias("time_end"), "in_bbox",
    )


# --- discovery ------------------------------------------------------------------------------


def _request(spark, sf):
    return V.obs(spark, sf).select("variable")


def sources_for_variables(spark, sf):
    s = D.sources_for_variables(_request(spark, sf), V.capabilities(spark, sf))
    return s.select("variable", F.array_join("sources", ",").alias("sources"))


def candidates(spark, sf):
    meta = V.metadata(spark, sf)
    info = meta.select("record_id", "source_id").join(
        D.dataset_info(meta, "package").withColumn("record_id", F.concat(F.lit("doi:"), "dataset_id")), "record_id"
    )
    request = _request(spark, sf).filter("variable in ('active_layer_thickness', 'ground_temperature')")
    found = D.screen(D.candidates(request, V.capabilities(spark, sf), info))
    return found.select(
        "source_id", "dataset_id", F.array_join("variables", ",").alias("variables"), "coverage", "license", "landing_page",
        "accepted", "reason",
    )


BOX = (-165.0, 60.0, -141.0, 70.0)


def search_coverage(spark, sf):
    return D.search_by_coverage(V.metadata(spark, sf), BOX, ("2001-01-01", "2006-12-31"), rows=None).select(
        "dataset_id", r6("coverage").alias("coverage")
    )


def search_coverage_top(spark, sf):
    return D.search_by_coverage(V.metadata(spark, sf), BOX, ("2001-01-01", "2006-12-31")).select("dataset_id", "rank")


def search_overlap(spark, sf):
    return D.search_by_overlap(
        V.metadata(spark, sf), ("soil_temperature", "machinery"), BOX, ("2001-01-01", "2006-12-31"), rows=None
    ).select("dataset_id")


def _requests(spark, sf):
    """suppliers as search requests: boxes of all sizes, some of the globe, some periods that cannot be read."""
    k = F.col("s_suppkey")
    half = lambda m, n: F.lit(-175.0) + (k * m % n) / F.lit(10.0)
    box = k % 7 != 0
    west, south = half(29, 420), F.lit(50.0) + (k * 11 % 230) / F.lit(10.0)
    wide = F.when(k % 5 == 0, F.lit(40.0)).otherwise((k % 60) / F.lit(10.0))
    return V.table(spark, sf, "supplier").select(
        k.alias("request_id"), F.when(box, west).alias("west"), F.when(box, south).alias("south"),
        F.when(box, west + wide).alias("east"), F.when(box, south + wide / 2).alias("north"),
        F.when(k % 4 != 0, F.concat((F.lit(1995) + k % 15).cast("string"), F.lit("-01-01"))).alias("begin"),
        F.when(k % 4 != 0, F.concat((F.lit(1998) + k % 15).cast("string"), F.lit("-12-31"))).alias("end"),
        F.when(k % 3 == 0, F.array(F.lit("soil_temperature"), F.lit("Machinery"))).when(k % 3 == 1, F.array(F.lit("survey"))).alias("terms"),
    )


REQUESTS_SQL = """asked as (select *, s_suppkey as k, -175.0::double + (s_suppkey * 29 % 420) / 10.0::double as rw,
    50.0::double + (s_suppkey * 11 % 230) / 10.0::double as rs, case when s_suppkey % 5 = 0 then 40.0::double else (s_suppkey % 60) / 10.0::double end as wide from supplier),
requests as (select k as request_id, case when k % 7 <> 0 then rw else -180 end as rw, case when k % 7 <> 0 then rs else -90 end as rs,
  case when k % 7 <> 0 then rw + wide else 180 end as re, case when k % 7 <> 0 then rs + wide / 2 else 90 end as rn,
  case when k % 4 <> 0 then (1995 + k % 15) || '-01-01' end as lo, case when k % 4 <> 0 then (1998 + k % 15) || '-12-31' end as hi from asked),
pairs as (select * from requests join meta on east >= rw and west <= re and north >= rs and south <= rn)"""


SHARES_SQL = """shares as (select *, least(re, east) - greatest(rw, west) as w, least(rn, north) - greatest(rs, south) as h,
    (east - west) * (north - south) as area from pairs),
covered as (select * from (select *, case when area <= 1e-9 then 1.0::double when w <= 0 or h <= 0 then 0 else w * h / area end as coverage from shares)
  where coverage >= 0.1 and coalesce(end_date >= lo and begin_date <= hi, true))"""


def requests_coverage(spark, sf):
    return Q.search_by_coverage(V.metadata(spark, sf), _requests(spark, sf), rows=None, digits=6).select("request_id", "dataset_id", "coverage")


def requests_coverage_top(spark, sf):
    return Q.search_by_coverage(V.metadata(spark, sf), _requests(spark, sf), rows=3).select("request_id", "dataset_id", "rank")


def requests_overlap(spark, sf):
    return Q.search_by_overlap(V.metadata(spark, sf), _requests(spark, sf), rows=None).select("request_id", "dataset_id")


def search_static(spark, sf):
    products = V.table(spark, sf, "customer").selectExpr(
        "c_custkey", "array(lower(c_mktsegment), 'elev') as keywords", "cast(50 + c_custkey % 20 as double) as south",
        "cast(2000 + c_custkey % 24 as int) as first_year",
    )
    return D.search_static(products, ("Machinery", "soil"), (-160.0, 55.0, -150.0, 61.5), ("2001-01-01", "2012-01-01")).select("c_custkey")


def dataset_info(spark, sf):
    return D.dataset_info(V.metadata(spark, sf), "package")


def _card_tables(spark, sf):
    registry = V.table(spark, sf, "nation").selectExpr(
        "concat('src_', n_nationkey) as source_id", "if(n_nationkey % 7 = 3, null, concat('card_', n_nationkey * if(n_nationkey % 6 = 5, -1, 1), '.md')) as card"
    )
    infos = V.table(spark, sf, "customer").selectExpr(
        "concat('src_', c_nationkey) as source_id", "concat('set_', c_custkey) as dataset_id",
        "if(c_nationkey = 8, null, concat('Author', chr(cast(97 + c_custkey % 3 as int)), ', A. (2020). https://doi.org/10.5555/x', c_custkey % 4, '.')) as citation",
    )
    cards = V.table(spark, sf, "documents").selectExpr(
        "concat('card_', doc_id, '.md') as card",
        "concat(text, ' Authora Authorb 10.5555/x0 10.5555/x1', if(doc_id % 2 = 0, ' 10.5555/x2', '')) as text",
    )
    return registry, infos, cards


def card_check(spark, sf):
    return D.card_report(D.check_cards(*_card_tables(spark, sf)))


CARDS_SQL = """registry as (
  select 'src_' || n_nationkey as source_id, case when n_nationkey % 7 <> 3 then
    'card_' || (n_nationkey * case when n_nationkey % 6 = 5 then -1 else 1 end) || '.md' end as card from nation),
infos as (
  select 'src_' || c_nationkey as source_id, 'set_' || c_custkey as dataset_id,
    case when c_nationkey <> 8 then 'Author' || chr(cast(97 + c_custkey % 3 as integer)) end as surname, '10.5555/x' || (c_custkey % 4) as doi from customer),
cards as (
  select 'card_' || doc_id || '.md' as card, text || ' Authora Authorb 10.5555/x0 10.5555/x1' || case when doc_id % 2 = 0 then ' 10.5555/x2' else '' end as text from documents),
base as (select * from registry left join cards using (card)),
problems as (
  select source_id, card, dataset_id, case when not contains(text, doi) then 'DOI missing from card: ' || doi end as p1,
    case when not contains(text, surname) then 'first author missing from card: ' || surname end as p2
  from base join infos using (source_id) where text is not null and surname is not null)"""

QUERIES = {
    "file_index": (file_index, V.with_ctes(*INDEX, body="""
select file_id, dataset_id, relative_path, role, format, bytes, content_checksum, md5 from indexed""")),
    "package_standard": (package_standard, V.with_ctes(V.FILES_SQL, body="""
select dataset_id, case when bool_or(relative_path = 'bagit.txt') then 'dataone_bagit'
  when bool_or(not contains(relative_path, '/') and (ends_with(lower(relative_path), '_dd.csv') or lower(relative_path) = 'flmd.csv'
    or ends_with(lower(relative_path), '_flmd.csv'))) then 'ess_dive_dd' else 'unknown' end as standard
from files group by dataset_id""")),
    "manifest_mismatch": (manifest_mismatch, V.with_ctes(*INDEX, body="""
select distinct i.dataset_id, i.relative_path, lower(f.declared_md5) as declared_md5 from indexed i join files f using (dataset_id, relative_path)
where lower(i.md5) <> lower(f.declared_md5)""")),
    "package_fingerprint": (package_fingerprint, V.with_ctes(*INDEX, body="""
select dataset_id, sha256(string_agg(relative_path || ':' || bytes, chr(10) order by relative_path, bytes)) as fingerprint from indexed group by dataset_id""")),
    "folder_files": (folder_files, f"""
with f as ({PACKAGES_SQL})
select dataset_id, relative_path, case when relative_path like '%dd.csv' then 'dictionary' when relative_path like '%.csv' then 'data'
    when relative_path like '%.xml' then 'eml' else 'bagit' end as role,
  case when relative_path like '%.csv' then 'csv' when relative_path like '%.xml' then 'xml' else 'text' end as format,
  cast(strlen(content) as bigint) as bytes, sha256(content) as content_checksum, md5(content) as md5,
  case when relative_path like '%2020.csv' then '-' || split_part(dataset_id, '_', 2) when relative_path like 'data/%' then '-99' end as missing_sentinel,
  case when cast(split_part(dataset_id, '_', 2) as bigint) % 2 = 0 then 'ess_dive_dd' else 'dataone_bagit' end as standard
from f where relative_path <> 'README.md'"""),
    "folder_variables": (folder_variables, """
with s as (select s_suppkey as k, 'set_' || s_suppkey as d from supplier),
v as (select d, 'T_' || k || '_2020.csv' as p, 'soil_temperature' as variable, 'soil_temperature_5cm' as raw_name, 'degC' as unit, 'pdf' as tier, true as ok from s where k % 2 = 0
  union all select d, 'T_' || k || '_2020.csv', 'site' || k % 5, 'site' || k % 5, null, 'pdf', false from s where k % 2 = 0
  union all select d, 'data/S_' || k || '.csv', 'excess_ice_content', 'EIC, %', 'percent', 'assumed-wgs84', true from s where k % 2 = 1
  union all select d, 'data/S_' || k || '.csv', 'Remark ' || k % 7, 'Remark ' || k % 7, null, 'assumed-wgs84', false from s where k % 2 = 1)
select d as dataset_id, variable, substr(sha256(d || '|' || p), 1, 16) as file_id, raw_name, unit, tier as crs_tier, ok as parseable from v"""),
    "folder_mismatches": (folder_mismatches, """
select 'set_' || s_suppkey as dataset_id, 'data/S_' || s_suppkey || '.csv' as relative_path, md5('other') as declared_md5
from supplier where s_suppkey % 2 = 1 and s_suppkey % 3 = 0"""),
    "dictionary_match": (dictionary_match, V.with_ctes(V.FILES_SQL, """parts as (
  select *, regexp_extract(relative_path, '([^/]*)$', 1) as name, regexp_replace(relative_path, '/?[^/]*$', '') as dir from files)""", body="""
select distinct d.dataset_id, d.relative_path as dictionary_path, coalesce(t.relative_path, d.relative_path) as target_path
from parts d left join parts t on t.dataset_id = d.dataset_id and t.dir = d.dir and ends_with(t.name, '.csv')
  and not ends_with(t.name, '_dd.csv') and not ends_with(t.name, '_flmd.csv') and starts_with(t.name, d.name[:-8])
where ends_with(d.name, '_dd.csv')""")),
    "entity_match": (entity_match, V.with_ctes(V.FILES_SQL, """parts as (
  select *, regexp_extract(relative_path, '([^/]*)$', 1) as name from files),
asked as (select doc_id, dataset_id, case doc_id % 3 when 0 then name when 1 then upper(replace(name, '_', ' - ')) else name || '.gone' end as entity from parts),
exact as (select dataset_id, name as entity, max(relative_path) as p1 from parts group by all),
fuzzy as (select dataset_id, lower(regexp_replace(name, '[\\s\\-_]+', '', 'g')) as f, max(relative_path) as p2 from parts group by all)""", body="""
select doc_id, entity, coalesce(p1, p2) as target_path from asked left join exact using (dataset_id, entity)
left join fuzzy on fuzzy.dataset_id = asked.dataset_id and f = lower(regexp_replace(entity, '[\\s\\-_]+', '', 'g'))
where coalesce(p1, p2) is not null""")),
    "sentinel_text": (sentinel_text, """
select doc_id, case doc_id % 3 when 0 then '-9999' when 1 then 'none given' end as sentinel from documents"""),
    "variable_rows": (variable_rows, V.with_ctes(DECLARED_SQL, """names as (
  select dataset_id, variable, file_id, string_agg(raw_name, ', ' order by o) as raw_name from (
    select dataset_id, variable, file_id, raw_name, min(ord) as o from keyed group by all) group by all),
units as (
  select dataset_id, variable, file_id, string_agg(unit, ', ' order by o) as unit from (
    select dataset_id, variable, file_id, unit, min(ord) as o from keyed where unit <> '' group by all) group by all)""", body="""
select dataset_id, variable, file_id, raw_name, unit, 'pdf' as crs_tier, not starts_with(variable, 'Notes') as parseable
from names left join units using (dataset_id, variable, file_id)""")),
    "file_sentinels": (file_sentinels, V.with_ctes(DECLARED_SQL, body="""
select dataset_id, file_id, string_agg(missing_sentinel, ', ' order by o) as missing_sentinel from (
  select dataset_id, file_id, missing_sentinel, min(ord) as o from declared where missing_sentinel is not null group by all) group by all""")),
    "variable_mapping": (variable_mapping, V.with_ctes(DECLARED_SQL, body="select ord, raw_name, mapped as variable from keyed")),
    "catalog_query": (catalog_query, V.with_ctes(*REPORT, body="""
select v.variable, s.source_id, v.dataset_id, s.name, i.relative_path, coalesce(unit, '') as unit, coalesce(depth_range, '') as depth_range
from vars v join indexed i using (file_id) join sets s on s.dataset_id = v.dataset_id where v.variable = 'soil_temperature' and parseable""")),
    "catalog_inspect": (catalog_inspect, V.with_ctes(*REPORT, body="""
select *, case when bytes < 1024 then bytes || 'B' when bytes < 1048576 then printf('%.1fKB', bytes / 1024.0)
  when bytes < 1073741824 then printf('%.1fMB', bytes / 1048576.0) else printf('%.2fGB', bytes / 1073741824.0) end as size from (
select s.source_id, s.dataset_id, s.name, (select count(*) from indexed i where i.dataset_id = s.dataset_id) as n_files,
  cast((select coalesce(sum(bytes), 0) from indexed i where i.dataset_id = s.dataset_id) as bigint) as bytes,
  (select count(*) from vars v where v.dataset_id = s.dataset_id) as n_vars,
  (select count(*) from vars v where v.dataset_id = s.dataset_id and parseable) as n_parseable from sets s)""")),
    "catalog_totals": (catalog_totals, V.with_ctes(*REPORT, body="""
select 'datasets' as metric, count(*) as n from sets union all select 'downloads', count(*) from region
union all select 'files', count(*) from indexed union all select 'bytes', cast(sum(bytes) as bigint) from indexed
union all select 'variables', count(*) from vars union all select 'parseable', count(*) from vars where parseable
union all select 'observations', count(*) from events""")),
    "variable_breakdown": (variable_breakdown, V.with_ctes(V.FILES_SQL, REPORT_SQL, body="""
select variable, count(*) as n from vars where parseable group by variable""")),
    "upsert": (upsert, """
with fresh as (select o_custkey * 2 as id, o_orderstatus as name, o_totalprice as amount from orders
  qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
select c_custkey as id, c_name as name, c_acctbal as amount from customer where c_custkey not in (select id from fresh)
union all select * from fresh"""),
    "stored_observations": (stored_observations, V.with_ctes(V.OBS_SQL, body="""
select 'o' || (ord // 3) as obs_id, dataset_id, variable, round(value, 6) as value, unit, depth_m,
  strftime(time_start, '%Y-%m-%d %H:%M:%S') as time_start, cast(null as varchar) as qc_flags, '{"k":"' || k || '"}' as extra
from obs qualify row_number() over (partition by dataset_id, ord // 3 order by ord desc) = 1""")),
    "replace_dataset": (replace_dataset, V.with_ctes(V.OBS_SQL, body="""
select obs_id, dataset_id, variable, round(value, 6) as value, unit, depth_m, strftime(time_start, '%Y-%m-%d %H:%M:%S') as time_start,
  cast(null as varchar) as qc_flags, '{"k":"' || k || '"}' as extra from obs where dataset_id not in (select 'ds_' || (o_custkey % 2) from orders)
union all select 'or_' || o_orderkey, 'ds_' || (o_custkey % 2), 'snow_depth', round(o_totalprice, 6), 'mm', null,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderstatus || ',x', null from orders""")),
    "duplicate_ids": (duplicate_ids, V.with_ctes(V.OBS_SQL, body="""
select obs_id, cast(2 as bigint) as n_datasets from obs where dataset_id <> 'ds_0' and ord in (select o_orderkey from orders)""")),
    "download_ids": (download_ids, V.with_ctes(*INDEX, body="""
select distinct file_id, dataset_id || '_' || substr(content_checksum, 1, 8) as download_id from indexed""")),
    "provenance_record": (provenance_record, V.with_ctes(V.METADATA_SQL, body="""
select c.dataset_id, c.source_id, case when m.name is null then 'https://x.org/' || m.k else m.url end as landing_page,
  case when m.name is not null then '10.5555/' || m.k end as doi, coalesce(m.name, c.dataset_id) as title,
  case when m.name is null then '' else m.text end as description, case when m.name is not null then m.license end as license,
  '2024-01-02T03:04:05Z' as access_timestamp, md5(m.c_name) as content_checksum_sha256, cast(m.k as varchar) as bytes_downloaded
from (select dataset_id, source_id, name, url, text, license, rank as k, 'Customer#' || lpad(cast(rank as varchar), 9, '0') as c_name from meta) m
join (select dataset_id, source_id from meta) c using (dataset_id)""")),
    "analysis_table": (analysis_table, V.with_ctes(*CANON, body="""
select obs_id, source_id, dataset_id, variable, round(value, 6) as value, unit,
  strftime(time_start, '%Y-%m-%d %H:%M:%S') as time_end, cast(null as boolean) as in_bbox from canon""")),
    "sources_for_variables": (sources_for_variables, V.with_ctes(V.OBS_SQL, V.CAPABILITIES_SQL, body="""
select variable, coalesce(string_agg(source_id, ',' order by source_id), '') as sources from (
  select distinct a.variable, c.source_id from (select distinct variable from obs) a left join caps c on c.variable = a.variable
    or (a.variable in ('soil_temperature', 'ground_temperature') and c.variable in ('soil_temperature', 'ground_temperature')))
group by variable""")),
    "candidates": (candidates, V.with_ctes(V.METADATA_SQL, V.CAPABILITIES_SQL, body="""
select m.source_id, replace(record_id, 'doi:', '') as dataset_id, s.variables,
  (case when west is null then 'unspecified' else 'bbox W' || west || ' S' || south || ' E' || east || ' N' || north end) || ' | ' ||
  coalesce(begin_date || ' to ' || end_date, 'unspecified') as coverage, license, url as landing_page, true as accepted,
  case when license is null then 'accepted automatically; no license recorded' else 'accepted automatically' end as reason
from meta m join (select source_id, string_agg(variable, ',' order by variable) as variables,
    bool_or(variable in ('active_layer_thickness', 'soil_temperature', 'ground_temperature')) as wanted from caps group by source_id) s using (source_id)
where wanted""")),
    "search_coverage": (search_coverage, V.with_ctes(V.METADATA_SQL, """share as (
  select *, least(-141, east) - greatest(-165, west) as w, least(70, north) - greatest(60, south) as h, (east - west) * (north - south) as area from meta)""", body="""
select dataset_id, round(cov, 6) as coverage from (
  select *, case when area <= 1e-9 and w >= 0 and h >= 0 then 1.0::double when w <= 0 or h <= 0 then 0 else w * h / area end as cov from share)
where cov >= 0.1 and coalesce(end_date >= '2001-01-01' and begin_date <= '2006-12-31', true) and west is not null""")),
    "search_coverage_top": (search_coverage_top, V.with_ctes(V.METADATA_SQL, """share as (
  select *, least(-141, east) - greatest(-165, west) as w, least(70, north) - greatest(60, south) as h, (east - west) * (north - south) as area from meta)""", body="""
select dataset_id, rank from (
  select *, case when area <= 1e-9 and w >= 0 and h >= 0 then 1.0::double when w <= 0 or h <= 0 then 0 else w * h / area end as cov from share)
where cov >= 0.1 and coalesce(end_date >= '2001-01-01' and begin_date <= '2006-12-31', true) and west is not null order by rank limit 10""")),
    "search_overlap": (search_overlap, V.with_ctes(V.METADATA_SQL, body="""
select dataset_id from meta where superseded_by is null and contains(lower(text), 'soil temperature') and contains(lower(text), 'machinery')
  and east >= -165 and west <= -141 and north >= 60 and south <= 70 and end_date >= '2001-01-01' and begin_date <= '2006-12-31'""")),
    "requests_coverage": (requests_coverage, V.with_ctes(V.METADATA_SQL, REQUESTS_SQL, SHARES_SQL, body="""
select request_id, dataset_id, round(coverage, 6) as coverage from covered""")),
    "requests_coverage_top": (requests_coverage_top, V.with_ctes(V.METADATA_SQL, REQUESTS_SQL, SHARES_SQL, body="""
select request_id, dataset_id, rank from covered qualify row_number() over (partition by request_id order by rank, dataset_id) <= 3""")),
    "requests_overlap": (requests_overlap, V.with_ctes(V.METADATA_SQL, REQUESTS_SQL, body="""
select request_id, dataset_id from pairs where superseded_by is null and coalesce(end_date >= lo, lo is null) and coalesce(begin_date <= hi, hi is null)
  and case request_id % 3 when 0 then contains(lower(text), 'soil temperature') and contains(lower(text), 'machinery') when 1 then contains(lower(text), 'survey') else true end""")),
    "search_static": (search_static, """
select c_custkey from customer where c_mktsegment = 'MACHINERY' and 50 + c_custkey % 20 <= 61.5 and 2000 + c_custkey % 24 <= 2012"""),
    "dataset_info": (dataset_info, V.with_ctes(V.METADATA_SQL, body="""
select replace(record_id, 'doi:', '') as dataset_id, coalesce(name, replace(record_id, 'doi:', '')) as name, substr(text, 1, 500) as description,
  case when west is null then 'unspecified' else 'bbox W' || west || ' S' || south || ' E' || east || ' N' || north end as spatial_coverage,
  coalesce(begin_date || ' to ' || end_date, 'unspecified') as temporal_coverage, 'package' as format, url, license from meta""")),
    "card_check": (card_check, V.with_ctes(CARDS_SQL, body="""
select source_id, card, cast(null as varchar) as dataset_id, 'error' as level, 'no source card mapped' as message from base where card is null
union all select source_id, card, null, 'error', 'source card does not exist' from base where card is not null and text is null
union all select source_id, card, dataset_id, case when p1 is null and p2 is null then 'ok' else 'error' end,
  case when p1 is null and p2 is null then 'citation consistent' else concat_ws('; ', p1, p2) end from problems
union all select source_id, card, null, 'skip', 'no citation declared' from base where text is not null
  and source_id not in (select source_id from infos where surname is not null)""")),
}
