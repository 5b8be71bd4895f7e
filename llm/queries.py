"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import chat, decontaminate, embeddings, extract, jaccard, langid, lm, manifest, mixing, search, suffixes, toxicity, urls
from llm.common import fold, table

# ---------------------------------------------------------------- 1 URL filter

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules decide teaches the two models; they decide the rest."""
    host, path = urls.host_and_path(F.col("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", host.alias("host"), path.alias("path"))
    pages = pages.withColumn("found", urls.longest_rule(F.col("host"), F.col("path"), RULES))
    model = urls.fit(pages.where("found is not null").select("url", (F.col("found.verdict") == "block").alias("rejected")))
    out = urls.judge(pages, model)
    return out.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", "verdict").alias("verdict"), "llr", "p_reject")


# ---------------------------------------------------------------- 2 HTML extraction


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = extract.extracted(pages, extract.fit(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# ---------------------------------------------------------------- 3 chat formatting


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"select cast(-7 as bigint) conv_id, cast(turn as bigint) turn, role, '{text}' text from values (0, 'user'), (1, 'assistant') as t(turn, role)")
    t = chat.DEFAULT
    out = chat.format_chats(turns.unionByName(extra))
    back = chat.read_back(F.col("formatted"))
    out = out.withColumn("back", back).withColumn(
        "learned", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"], t)), ""))
    spoken = F.array_join(F.transform("back", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


_E = "replace(replace(replace(replace({0}, '\\', '\\0'), '<', '\\1'), '|', '\\2'), '[', '\\3')"
OP3_SQL = f"""
with t as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n as (select *, lag(role) over (partition by conv_id order by turn, role, text) before from t)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) loss_sha256,
  cast(sum(length({_E.format('role')}) + length({_E.format('text')}) + 11) as bigint) formatted_chars,
  bool_and((before is null and role in ('system', 'user')) or (before in ('system', 'assistant') and role = 'user')
    or (before = 'user' and role = 'assistant')) and arg_max(role, (turn, role, text)) in ('user', 'assistant') as valid
from n group by conv_id"""

# ---------------------------------------------------------------- 4 language-model scoring


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = (fold(F.col("doc_id"), 7) == 2).alias("held_out")
    return lm.scored(table(spark, sf_dir, "documents").select("doc_id", "text", held))


# ---------------------------------------------------------------- 5 n-gram Jaccard join


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, num=85, den=100)


# ---------------------------------------------------------------- 6 mixing

TARGETS = {
    "source": {"src0": 0.15, **{f"src{i}": 0.05 for i in range(1, 10)}},
    "lang": {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2},
    "topic": {"article": 0.6, "table": 0.1, "licensed": 0.1, "note": 0.2},
}


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.mixed(table(spark, sf_dir, "documents"), TARGETS, seed=6)
    return docs.select("doc_id", "cell.source", "cell.lang", "cell.topic", F.round("prob", 6).alias("prob"), "kept")


def _values(d: str) -> str:
    return ", ".join(f"('{d}', '{k}', {g!r})" for k, g in TARGETS[d].items())


def _rake(d: str, src: str) -> str:
    return f"select k, source, lang, topic, tokens, w * (select goal from goals g where g.d = '{d}' and g.v = {src}.{d}) / nullif(sum(w) over (partition by {d}), 0) w from {src}"


OP6_SQL = f"""
with recursive target(d, v, t) as (values {', '.join(map(_values, TARGETS))}),
topics as (select *, case when contains(coalesce(text, ''), ' | ') then 'table' when contains(coalesce(text, ''), 'Licensed under') then 'licensed'
    when contains(coalesce(text, ''), chr(10)) then 'article' else 'note' end tp from documents),
docs as (select doc_id, case when source in (select v from target where d = 'source') then source else '*' end source,
    case when lang in (select v from target where d = 'lang') then lang else '*' end lang,
    case when tp in (select v from target where d = 'topic') then tp else '*' end topic,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) n from topics),
cells as (select source, lang, topic, cast(sum(n) as double) tokens from docs group by all),
shares as (select *, tokens / sum(tokens) over () w from cells),
present as (select 'source' d, source v, sum(w) p from shares group by source union all select 'lang', lang, sum(w) from shares group by lang
    union all select 'topic', topic, sum(w) from shares group by topic),
asked as (select present.d, present.v, p, t, sum(t) over (partition by present.d) total, sum(case when t is null then p else 0 end) over (partition by present.d) free
    from present left join target on present.d = target.d and present.v = target.v),
goals as (select d, v, case when t is null then p else t / total * (1 - free) end goal from asked),
it as (select 0 k, source, lang, topic, tokens, w from shares union all
  select k + 1, source, lang, topic, tokens, w from (
    with a as ({_rake('source', 'it')}), b as ({_rake('lang', 'a')}), c as ({_rake('topic', 'b')}) select * from c) where k < {mixing.ROUNDS}),
fit as (select source, lang, topic, w, tokens / sum(tokens) over () share, case when tokens > 0 then w / (tokens / sum(tokens) over ()) end ratio from it where k = {mixing.ROUNDS}),
cum as (select *, coalesce(sum(share) over (order by ratio desc, source, lang, topic rows between unbounded preceding and 1 preceding), 0) filled,
  sum(w) over (order by ratio desc, source, lang, topic rows between current row and unbounded following) rest from fit where ratio is not null),
scales as (select *, (0.5 - filled) / nullif(rest, 0) scale from cum),
chosen as (select arg_max(scale, ratio) scale from scales where scale * ratio <= 1),
probs as (select source, lang, topic, coalesce(least(1.0, (select scale from chosen) * ratio), 1.0) prob from fit)
select doc_id, source, lang, topic, round(prob, 6) prob,
  cast(('0x' || substr(md5('6|' || coalesce(cast(doc_id as varchar), '')), 1, 13)) as ubigint)::double / 4503599627370496.0 < prob kept
from docs join probs using (source, lang, topic)"""


# ---------------------------------------------------------------- 7 embedding near-duplicates


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.deduplicated(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.95)


# ---------------------------------------------------------------- 8 language ID


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = (fold(F.col("doc_id"), 4) == 2).alias("held_out")
    model = langid.fit(docs.where(~held))
    out = langid.identified(docs.select("doc_id", held, "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


# ---------------------------------------------------------------- 9 toxicity


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = (fold(F.col("doc_id"), 3) == 1).alias("held_out")
    model = toxicity.fit(docs, labels.where(~held))
    out = toxicity.scored(docs.select("doc_id", held, "text"), model)
    return out.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"), "weight")


# ---------------------------------------------------------------- 10 benchmark decontamination


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "coverage", "contaminated", F.size("matches").alias("n_items"))


# ---------------------------------------------------------------- 11 ranked search


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = "unnest(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + search.TERM + "')) term"
OP11_SQL = f"""
with d as (select doc_id, row_number() over () r, text from documents), t as materialized (select r, {_TERMS.replace('{0}', 'text')} from d),
lens as materialized (select r, count(*) n from t group by r), total as materialized (select count(*) docs, cast(sum(n) as bigint) terms from lens),
p as (select r, term, count(*) tf from t group by r, term),
w as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) w from p, total group by term, docs),
items as (select item_id, term, count(*) q from (select item_id, {_TERMS.replace('{0}', 'text')} from (select distinct item_id, text from benchmark)) group by item_id, term),
s as (select item_id, r, cast(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) as bigint) score
  from items join w using (term) join p using (term) join lens using (r), total group by item_id, r)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls first) as integer) rank, doc_id, score
from s join d using (r) where score > 0 qualify rank <= 20"""


# ---------------------------------------------------------------- 12 Merkle manifest


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


_SQL_LEVELS = 8  # of runs of eight: groups of up to 8^8 leaves


def _run(grp: str, level: int) -> str:
    """The level's nodes with what lies left and right of each in its run; ``up`` is the node above."""
    side = "coalesce(string_agg(h, '') over (partition by {g}, pos // 8 order by pos rows between {a} and {b}), '')"
    left, right = side.format(g=grp, a="unbounded preceding", b="1 preceding"), side.format(g=grp, a="1 following", b="unbounded following")
    return f"select {grp}, pos, h, {left} l, {right} r, count(*) over (partition by {grp}) > 1 as more from n{level}"


def _tree(grp: str, start: str, name: str) -> str:
    """CTEs of one tree a group: {name}_up has for each leaf (grp, pos) the arrays of left and right parts, and the root."""
    out = f"n0 as materialized ({start})"
    for k in range(_SQL_LEVELS):
        out += f", r{k} as materialized ({_run(grp, k)}), n{k + 1} as materialized (select {grp}, pos // 8 pos, case when any_value(more) then sha256(string_agg(h, '' order by pos)) else any_value(h) end h from r{k} group by {grp}, pos // 8)"
    joins = " ".join(f"join r{k} on r{k}.{grp} is not distinct from n0.{grp} and r{k}.pos = n0.pos // {8**k}" for k in range(_SQL_LEVELS))
    parts = ", ".join(f"case when r{k}.more then [{{'l': r{k}.l, 'r': r{k}.r}}] else [] end" for k in range(_SQL_LEVELS))
    top = f"join n{_SQL_LEVELS} t on t.{grp} is not distinct from n0.{grp}"
    return f"{name}_up as materialized (with {out} select n0.{grp}, n0.pos, t.h top, flatten([{parts}]) way from n0 {joins} {top})"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || cast({c} as varchar) end" for c in fields) + ")"


_BITS = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
_CRC = ("xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))), "
        f"lambda a, b: list_reduce(list_prepend(xor(a, b), cast(range(8) as bigint[])), lambda c, z: {_BITS})))")
_FOLD = "list_reduce(list_prepend({{'l': '', 'r': {0}}}, way), lambda a, s: {{'l': '', 'r': sha256(s.l || a.r || s.r)}}).r"
OP12_SQL = f"""
with leaves as materialized (select doc_id, lang, {_leaf("text")} h, {_leaf(f"translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} low,
    doc_id is not null and {_CRC} % 3 = 0 as bad from documents),
placed as materialized (select *, row_number() over (partition by lang order by doc_id nulls first, h) - 1 pos from leaves),
{_tree("lang", "select lang, pos, h from placed", "leaf")},
subs as materialized (select lang, top as subroot, row_number() over (order by lang nulls first) - 1 pos, 0 as one from (select distinct lang, top from leaf_up)),
{_tree("one", "select one, pos, subroot h from subs", "sub")},
ways as (select doc_id, h leaf, case when bad then low else h end start, subroot, s.top root, list_concat(u.way, s.way) way from placed
  join leaf_up u on u.lang is not distinct from placed.lang and u.pos = placed.pos join subs on subs.lang is not distinct from placed.lang join sub_up s on s.pos = subs.pos),
done as (select *, {_FOLD.format("start")} folded_root from ways)
select doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(list_prepend({{'l': '', 'r': ''}}, way), lambda s: s.l || s.r), 'string_agg', '')) proof_sha256,
  folded_root, folded_root = root verified from done"""

# ---------------------------------------------------------------- 13 suffix dedup


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = """
with d as materialized (select row_number() over () r, doc_id, encode(coalesce(text, '')) b from documents),
w as materialized (select r, doc_id, p, b[p + 1 : p + 50] x from (select r, doc_id, b, unnest(range(octet_length(b) - 49)) p from d where octet_length(b) >= 50)),
firsts as (select x, min(doc_id) low from w group by x having count(*) > 1),
hit as materialized (select r, p from w join firsts using (x) where coalesce(low < doc_id, low is not null)),
spans as materialized (select r, min(p) a, max(p) + 50 z from (select r, p, sum(new) over (partition by r order by p) g
  from (select r, p, case when p <= lag(p) over (partition by r order by p) + 50 then 0 else 1 end new from hit)) group by r, g),
kept as (select r, coalesce(lag(z) over (partition by r order by a), 0) a, a as z from (select r, a, z from spans union all select r, octet_length(b), octet_length(b) from d)),
texts as (select r, string_agg(hex(b[kept.a + 1 : kept.z]), '' order by kept.a) k from kept join d using (r) group by r),
gone as (select r, sum(z - a) n, count(*) c from spans group by r)
select doc_id, cast(octet_length(b) as bigint) n_bytes, cast(coalesce(n, 0) as bigint) n_removed, cast(coalesce(c, 0) as bigint) n_spans, sha256(unhex(k)) kept_sha256
from d join texts using (r) left join gone using (r)"""


QUERIES = {
    "op1_url_filter": (op1_url_filter, None),
    "op2_html_extract": (op2_html_extract, None),
    "op3_chat_format": (op3_chat_format, OP3_SQL),
    "op4_lm_score": (op4_lm_score, None),
    "op5_jaccard_join": (op5_jaccard_join, None),
    "op6_mix_sources": (op6_mix_sources, OP6_SQL),
    "op7_embedding_dedup": (op7_embedding_dedup, None),
    "op8_language_id": (op8_language_id, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_decontaminate": (op10_decontaminate, None),
    "op11_ranked_search": (op11_ranked_search, OP11_SQL),
    "op12_merkle_manifest": (op12_merkle_manifest, OP12_SQL),
    "op13_suffix_dedup": (op13_suffix_dedup, OP13_SQL),
}
