"""Units, distributions, rule-based checks and cross-source co-location."""

from pyspark.sql import functions as F

from cairn.functions.text import fixed
from cairn.operators import colocate as C
from cairn.operators import qc, units
from cairn.plans.assemble import AssemblyRequest, harmonise, run, summary
from queries import views as V

r6 = lambda c: F.round(c, 6)


def canon(spark, sf):
    return units.to_canonical(V.obs(spark, sf))


CANON = (V.OBS_SQL, V.CANONICAL_SQL)

RANGES_SQL = """bounds(variable, lo, hi) as (values
    ('active_layer_thickness', cast(0 as double), cast(10 as double)), ('ground_temperature', -60, 40),
    ('volumetric_water_content', 0, 1), ('snow_depth', 0, 30))"""


def unit_canonical(spark, sf):
    return canon(spark, sf).select(
        "obs_id", "variable", "unit", r6("value").alias("value"),
        r6("latitude").alias("latitude"), r6("longitude").alias("longitude"), r6("depth_m").alias("depth_m"),
    )


def qc_units(spark, sf):
    return units.unit_problems(canon(spark, sf)).select("obs_id", "variable", "unit", "canonical_unit")


def distribution_summary(spark, sf):
    d = qc.distribution_summary(canon(spark, sf))
    return d.select(
        "variable", "n", r6("min").alias("min"), r6("median").alias("median"), r6("max").alias("max"),
        "n_with_depth", "depth_min", "depth_max",
    )


def qc_value_range(spark, sf):
    d = qc.value_range_report(canon(spark, sf))
    text = F.transform("examples", lambda v: fixed(v, 4))
    return d.select(
        "variable", "n_bad", "n_total", r6("min").alias("min"), r6("max").alias("max"), "lo", "hi",
        F.array_join(text, ",").alias("examples"),
    )


def qc_depth(spark, sf):
    return qc.depth_report(V.obs(spark, sf))


def qc_serves(spark, sf):
    return qc.declared_not_emitted(V.capabilities(spark, sf), V.obs(spark, sf))


def qc_present_variables(spark, sf):
    return qc.present_variables(V.obs(spark, sf))


def qc_validate(spark, sf):
    f = qc.validate_observations(V.capabilities(spark, sf), canon(spark, sf))
    return f.select("check", "severity", "variable")


def qc_rollup(spark, sf):
    return qc.finding_counts(
        qc.validate_observations(V.capabilities(spark, sf), canon(spark, sf))
    )


def _staged(spark, sf):
    """Documents as the root files of staged folders, one folder per source and language."""
    d = V.table(spark, sf, "documents")
    names = F.array(*[F.lit(n) for n in ("PROVENANCE.json", "CITATION.cff", "README.md", "metadata.txt", "data/eml.xml")])
    folder = F.concat_ws("_", "source", "lang", (F.col("n_chars") % 500).cast("string"))
    return d.select(folder.alias("dataset_id"), F.get(names, (F.col("doc_id") % 5).cast("int")).alias("relative_path"))


STAGED_SQL = """staged as (
  select source || '_' || lang || '_' || (n_chars % 500) as dataset_id,
    case doc_id % 5 when 0 then 'PROVENANCE.json' when 1 then 'CITATION.cff' when 2 then 'README.md'
      when 3 then 'metadata.txt' else 'data/eml.xml' end as relative_path from documents)"""


def _folders(spark, sf):
    """The staged folders, and one per supplier that holds no file."""
    bare = V.table(spark, sf, "supplier").select(F.concat(F.lit("empty_"), F.col("s_suppkey").cast("string")).alias("dataset_id"))
    return _staged(spark, sf).select("dataset_id").distinct().unionByName(bare)


def qc_required_files(spark, sf):
    return qc.missing_files(_staged(spark, sf), _folders(spark, sf))


def qc_staged(spark, sf):
    """All findings on staged folders, counted."""
    return qc.finding_counts(qc.validate_staged(_staged(spark, sf), _records(spark, sf), _folders(spark, sf)))


def qc_native_metadata(spark, sf):
    return qc.lacking_native_metadata(_staged(spark, sf), _folders(spark, sf))


def _records(spark, sf):
    """Documents as provenance JSON; some cite themselves, some are not JSON."""
    n = F.col("doc_id")
    title, url = F.concat(F.lit("Set "), n.cast("string")), F.concat(F.lit("https://x.org/"), n.cast("string"))
    citation = F.when(n % 4 == 0, F.concat(title, F.lit(". "), url)).when(n % 4 == 1, F.col("text"))
    record = F.to_json(F.struct(
        title.alias("title"), citation.alias("citation"),
        F.when(n % 3 != 0, url).alias("source_url"), url.alias("landing_page"),
    ))
    return V.table(spark, sf, "documents").select(
        F.concat(F.lit("set_"), n.cast("string")).alias("dataset_id"),
        F.when(n % 10 == 7, F.concat(F.lit("{broken "), F.regexp_replace("text", '["{}]', ""))).otherwise(record).alias("content"),
    )


def qc_records(spark, sf):
    f = qc.check_records(_records(spark, sf))
    return f.select("check", "severity", F.get_json_object("detail", "$.dataset_id").alias("dataset_id"))


# --- co-location ------------------------------------------------------------------------

def half_up(column, digits):
    """Decimal half-up rounding of a double in SQL."""
    return f"cast(round(cast(round({column}, 10) as decimal(30, 10)), {digits}) as double)"


PAIRS_SQL = """counted as (select variable, source_id, count(*) as n from canon group by all),
pairs as (
  select a.variable, a.source_id as a_source, o.source_id as o_source, a.n as n_anchor, o.n as n_other
  from counted a join counted o on a.variable = o.variable
    and (a.n < o.n or (a.n = o.n and a.source_id < o.source_id))),
near as (
  select p.variable, p.a_source, p.o_source, a.obs_id, a.ord, a.latitude, a.longitude, a.depth_m, a.value,
    o.value as other_value
  from pairs p
  join canon a on a.variable = p.variable and a.source_id = p.a_source
  join canon o on o.variable = p.variable and o.source_id = p.o_source
    and o.latitude between a.latitude - 5.0::double / 111.0::double and a.latitude + 5.0::double / 111.0::double
    and o.longitude between a.longitude - 5.0::double / (111.0::double * greatest(cos(radians(a.latitude)), 1e-6::double))
      and a.longitude + 5.0::double / (111.0::double * greatest(cos(radians(a.latitude)), 1e-6::double))
    and abs(coalesce(o.depth_m, 0) - coalesce(a.depth_m, 0)) <= 1.0
    and 2 * 6371.0::double * asin(sqrt(least(greatest(
      pow(sin((radians(o.latitude) - radians(a.latitude)) / 2), 2) + cos(radians(a.latitude)) * cos(radians(o.latitude))
      * pow(sin((radians(o.longitude) - radians(a.longitude)) / 2), 2), 0), 1))) <= 5.0),
met as (
  select *, variable = 'ground_temperature' as interval_scale,
    case when variable = 'ground_temperature' then other_mean - value
      when value > 0 and other_mean > 0 then other_mean / value end as metric
  from (select variable, a_source as anchor_source, o_source as other_source, obs_id, ord, latitude, longitude, depth_m,
      value, avg(other_value) as other_mean, count(*) as n_near
    from near group by all)),
scored as (
  select *, case when interval_scale then abs(reported) else abs(reported - 1.0::double) end as strength,
    case when interval_scale then 2.0::double else 0.2::double end as tol
  from (select *, """ + half_up("metric", 3) + """ as reported from met))"""

COLOCATE = (*CANON, PAIRS_SQL)


def source_pairs(spark, sf):
    return C.source_pairs(canon(spark, sf)).select(
        "variable", F.col("anchor_source"), "other_source", "n_anchor", "n_other"
    )


def colocate_metrics(spark, sf):
    return C.colocate(canon(spark, sf)).select(
        "obs_id", "variable", "anchor_source", "other_source", "n_near",
        C.reported(F.col("other_mean"), 8).alias("other_mean"), C.reported(F.col("metric"), 8).alias("metric"),
    )


def cross_source_findings(spark, sf):
    f = C.consistency_report(canon(spark, sf))
    return f.select(
        "variable", "check", F.array_join("sources", ",").alias("sources"), "n_spatial", "n_colocated",
        "n_disagreements", "metric", F.round("median_metric", 9).alias("median_metric"),
        F.coalesce(F.array_join("pair_labels", ", "), F.lit("")).alias("pair_labels"),
    )


def cross_source_worst_sites(spark, sf):
    w = C.worst_sites(C.colocate(canon(spark, sf)))
    return w.select(
        "variable", F.col("rank").cast("long").alias("rank"), "obs_id", "anchor_source", "other_source",
        "lat", "lon", "n_near", "anchor", "other", "metric",
    )


# --- assembly -----------------------------------------------------------------------------

REQUEST = AssemblyRequest(
    variables=("active_layer_thickness", "ground_temperature", "no_such_variable"),
    bbox=(-160.0, 62.0, -140.0, 68.0),
    time_range=("2024-01-05", "2024-01"),
)


def _by_dataset(spark, sf):
    o = V.obs(spark, sf)
    return [o.filter(F.col("variable") == v) for v in ("active_layer_thickness", "ground_temperature", "volumetric_water_content", "snow_depth", "thaw_event_label")]


def assemble(spark, sf):
    a = harmonise(_by_dataset(spark, sf), REQUEST)
    return a.select(
        "obs_id", F.col("provenance.source_id").alias("source_id"), "dataset_id", "variable",
        r6("value").alias("value"), "unit", "in_bbox", "in_time_range",
    )


def assemble_summary(spark, sf):
    return summary(harmonise([V.obs(spark, sf)]))


def assemble_notes(spark, sf):
    """Notes of a whole run; two of its datasets fail, one that lies off the globe and one without rows."""
    parts = dict(zip(("thaw", "ground", "water", "snow", "events"), _by_dataset(spark, sf)))
    off = F.when(F.col("ord") % 2 == 0, F.col("latitude") + 100)
    parts["off_survey"] = parts["snow"].withColumn("latitude", off)
    parts["empty_survey"] = parts["snow"].filter("false")
    return run(parts, AssemblyRequest(), "").notes


QUERIES = {
    "unit_canonical": (unit_canonical, V.with_ctes(*CANON, body="""
select obs_id, variable, unit, round(value, 6) as value, round(latitude, 6) as latitude,
  round(longitude, 6) as longitude, round(depth_m, 6) as depth_m from canon""")),
    "qc_units": (qc_units, V.with_ctes(*CANON, body="""
select obs_id, variable, unit, target as canonical_unit from canon where target is not null and unit <> target""")),
    "distribution_summary": (distribution_summary, V.with_ctes(*CANON, body="""
select variable, count(*) as n, round(min(value), 6) as min, round(median(value), 6) as median,
  round(max(value), 6) as max, count(depth_m) as n_with_depth, min(depth_m) as depth_min, max(depth_m) as depth_max
from canon group by variable""")),
    "qc_value_range": (qc_value_range, V.with_ctes(*CANON, RANGES_SQL, """flagged as (
  select c.*, lo, hi, not isnan(value) and (value < lo or value > hi) as bad from canon c join bounds using (variable)),
offenders as (
  select variable, string_agg(printf('%.4f', value), ',' order by value) as examples from (
    select variable, value, row_number() over (partition by variable order by value) as rn
    from (select distinct variable, value from flagged where bad)) where rn <= 5 group by variable)""", body="""
select variable, cast(count(*) filter (where bad) as bigint) as n_bad, count(*) as n_total, round(min(value), 6) as min,
  round(max(value), 6) as max, lo, hi, examples
from flagged join offenders using (variable) group by variable, lo, hi, examples""")),
    "qc_depth": (qc_depth, V.with_ctes(V.OBS_SQL, body="""
select variable, cast(count(*) filter (where depth_m is null) as bigint) as n_missing,
  cast(count(*) filter (where depth_m < 0) as bigint) as n_negative, count(*) as n_total
from obs where variable in ('ground_temperature', 'volumetric_water_content') group by variable""")),
    "qc_serves": (qc_serves, V.with_ctes(V.OBS_SQL, V.CAPABILITIES_SQL, body="""
select variable from caps except select variable from obs""")),
    "qc_present_variables": (qc_present_variables, V.with_ctes(V.OBS_SQL, body="select distinct variable from obs")),
    "qc_validate": (qc_validate, V.with_ctes(*CANON, V.CAPABILITIES_SQL, RANGES_SQL, body="""
select 'serves_subset_emitted' as "check", 'error' as severity, variable from
  (select variable from caps except select variable from canon)
union all select distinct 'value_range', 'error', variable from canon join bounds using (variable)
  where not isnan(value) and (value < lo or value > hi)
union all select distinct 'subsurface_depth_missing', 'error', variable from canon
  where variable in ('ground_temperature', 'volumetric_water_content') and depth_m is null
union all select distinct 'subsurface_depth_negative', 'error', variable from canon
  where variable in ('ground_temperature', 'volumetric_water_content') and depth_m < 0""")),
    "qc_rollup": (qc_rollup, V.with_ctes(*CANON, V.CAPABILITIES_SQL, RANGES_SQL, """found as (
select 'serves_subset_emitted' as "check", 'error' as severity, variable from
  (select variable from caps except select variable from canon)
union all select distinct 'value_range', 'error', variable from canon join bounds using (variable)
  where not isnan(value) and (value < lo or value > hi)
union all select distinct 'subsurface_depth_missing', 'error', variable from canon
  where variable in ('ground_temperature', 'volumetric_water_content') and depth_m is null
union all select distinct 'subsurface_depth_negative', 'error', variable from canon
  where variable in ('ground_temperature', 'volumetric_water_content') and depth_m < 0)""", body="""
select severity, "check", count(*) as n from found group by all""")),
    "qc_staged": (qc_staged, V.with_ctes(STAGED_SQL, """folders as (select dataset_id from staged union select 'empty_' || s_suppkey from supplier),
found as (
  select 'self_describing_missing' as "check", 'error' as severity from folders d, (values ('PROVENANCE.json'), ('CITATION.cff'), ('README.md')) r(file_name)
  where not exists (select 1 from staged s where s.dataset_id = d.dataset_id and s.relative_path = r.file_name)
  union all select 'self_describing_no_native', 'warning' from folders d where not exists (
    select 1 from staged s where s.dataset_id = d.dataset_id and (s.relative_path in ('metadata.json', 'metadata.txt') or s.relative_path like '%.xml'))
  union all select 'provenance_unreadable', 'error' from documents where doc_id % 10 = 7
  union all select 'citation_synthesized', 'error' from documents where doc_id % 10 <> 7 and doc_id % 4 = 0)""", body="""
select severity, "check", count(*) as n from found group by all""")),
    "qc_required_files": (qc_required_files, V.with_ctes(STAGED_SQL, body="""
select d.dataset_id, r.file_name from (select dataset_id from staged union select 'empty_' || s_suppkey from supplier) d,
  (values ('PROVENANCE.json'), ('CITATION.cff'), ('README.md')) r(file_name)
where not exists (select 1 from staged s where s.dataset_id = d.dataset_id and s.relative_path = r.file_name)""")),
    "qc_native_metadata": (qc_native_metadata, V.with_ctes(STAGED_SQL, body="""
select dataset_id from staged group by dataset_id
having not bool_or(relative_path in ('metadata.json', 'metadata.txt') or relative_path like '%.xml')
union all select 'empty_' || s_suppkey from supplier""")),
    "qc_records": (qc_records, """
select 'provenance_unreadable' as "check", 'error' as severity, 'set_' || doc_id as dataset_id from documents where doc_id % 10 = 7
union all select 'citation_synthesized', 'error', 'set_' || doc_id from documents where doc_id % 10 <> 7 and doc_id % 4 = 0"""),
    "source_pairs": (source_pairs, V.with_ctes(*CANON, """counted as (select variable, source_id, count(*) as n from canon group by all)""", body="""
select a.variable, a.source_id as anchor_source, o.source_id as other_source, a.n as n_anchor, o.n as n_other
from counted a join counted o on a.variable = o.variable
  and (a.n < o.n or (a.n = o.n and a.source_id < o.source_id))""")),
    "colocate_metrics": (colocate_metrics, V.with_ctes(*COLOCATE, body=f"""
select obs_id, variable, anchor_source, other_source, n_near, {half_up("other_mean", 8)} as other_mean,
  {half_up("metric", 8)} as metric from met""")),
    "cross_source_findings": (cross_source_findings, V.with_ctes(*COLOCATE, """labels as (
  select variable, string_agg(anchor_source || ' vs ' || other_source, ', '
      order by least(anchor_source, other_source), greatest(anchor_source, other_source)) as pair_labels
  from (select distinct variable, anchor_source, other_source from met where metric is not null) group by variable),
providers as (
  select variable, string_agg(source_id, ',' order by source_id) as sources from counted group by variable having count(*) >= 2),
tallies as (
  select variable, count(*) as n_spatial, count(metric) as n_colocated, count(*) filter (where strength > tol) as n_disagreements,
    median(metric) as median_metric from scored group by variable)""", body="""
select variable, case when coalesce(n_spatial, 0) = 0 then 'cross_source_no_overlap'
    when n_colocated = 0 then 'cross_source_metric_uncomputable' else 'cross_source_consistency' end as "check",
  sources, coalesce(n_spatial, 0) as n_spatial, coalesce(n_colocated, 0) as n_colocated,
  coalesce(n_disagreements, 0) as n_disagreements,
  case when variable = 'ground_temperature' then 'difference' else 'ratio' end as metric,
  round(median_metric, 9) + 0.0 as median_metric, coalesce(pair_labels, '') as pair_labels
from providers left join tallies using (variable) left join labels using (variable)""")),
    "cross_source_worst_sites": (cross_source_worst_sites, V.with_ctes(*COLOCATE, body=f"""
select variable, rank, obs_id, anchor_source, other_source, {half_up("latitude", 4)} as lat, {half_up("longitude", 4)} as lon, n_near,
  {half_up("value", 4)} as anchor, {half_up("other_mean", 4)} as other, reported as metric
from (select *, row_number() over (partition by variable order by strength desc, ord, other_source) as rank
  from scored where metric is not null and strength > tol) where rank <= 8""")),
    "assemble": (assemble, V.with_ctes(*CANON, body="""
select obs_id, source_id, dataset_id, variable, round(value, 6) as value, unit,
  longitude between -160 and -140 and latitude between 62 and 68 as in_bbox,
  time_start between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-31 23:59:59' as in_time_range
from canon where variable in ('active_layer_thickness', 'ground_temperature')""")),
    "assemble_summary": (assemble_summary, V.with_ctes(*CANON, body="""
select 'n_observations' as metric, count(*) as n from canon
union all select 'cross_source_warnings', count(*) from
  (select variable from canon group by variable having count(distinct source_id) >= 2)
union all select 'unit_contract_problems', count(*) from canon where target is not null and unit <> target""")),
}


def _notes_sql():
    """The lines, from the SQL of the reports they are made of."""
    number = lambda c: f"printf('%.3g', {c})"
    cross, dist, problems = (QUERIES[q][1] for q in ("cross_source_findings", "distribution_summary", "qc_units"))
    return f"""
with report as ({cross}), dist as ({dist}), problems as ({problems}),
snow as (select count(*) as n, count(*) filter (where event_id % 2 = 1) as odd from events where event_type = 'signup')
select 1 as section, variable as line_ord, variable || ': n=' || n || ' min=' || {number("min")} || ' median=' || {number("median")} || ' max=' || {number("max")}
  || case when n_with_depth > 0 then ', depth ' || depth_min || '-' || depth_max || ' m (' || n_with_depth || ' with depth)' else '' end as line from dist
union all select 2, variable, '[warning] ' || "check" || ': ' || variable || case "check"
  when 'cross_source_no_overlap' then ': sources ' || replace(sources, ',', ', ') || ' never meet within 5.0 km'
  when 'cross_source_metric_uncomputable' then ': ' || n_spatial || ' meetings of ' || replace(sources, ',', ', ') || ', none with a usable metric'
  else ': ' || n_colocated || ' meetings of ' || pair_labels || ', median ' || metric || ' ' || printf('%.2f', median_metric) || ', ' || n_disagreements || ' beyond tolerance' end from report
union all select 3, '', 'unit problems: ' || count(*) from problems having count(*) > 0
union all select 4, 'off_survey', 'failed: off_survey: ' || case when n = 0 then 'no rows' else 'no usable row of ' || n || ' (' || concat_ws(', ',
  case when odd > 0 then odd || ' without coordinates' end, case when n > odd then n - odd || ' beyond the coordinate range' end) || ')' end from snow
union all select 4, 'empty_survey', 'failed: empty_survey: no rows'"""


QUERIES["assemble_notes"] = (assemble_notes, _notes_sql())
