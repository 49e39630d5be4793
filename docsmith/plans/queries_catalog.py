"""Registered queries for filters, classification, labels, joins,
aggregations and scalar operators (see ``queries.py`` for the TXT family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsmith.functions import labels as LB
from docsmith.functions.scores import one_decimal, stars
from docsmith.functions.text import format_method_doc, section_label, thousands, truncate_doc
from docsmith.operators import catalog as CT
from docsmith.operators import filters as FL
from docsmith.operators import helpparse as hp
from docsmith.operators import hierarchy as HY
from docsmith.operators import labelling as LL
from docsmith.operators import pages as PG
from docsmith.plans import oracle as O
from docsmith.plans.queries import _PARSE, _help, query
from docsmith.plans.views import duck_with, spark_view

NL = O.NL


def V(spark, sf, name):
    return spark_view(spark, name, sf)


# --------------------------------------------------------------------------
# FLT
# --------------------------------------------------------------------------

@query("flt1_inventory_filter", duck_with("v_inventory") + """
select module_name, class_name from v_inventory
where starts_with(class_name, 'vtk') and not starts_with(class_name, 'vtk_') and not starts_with(class_name, 'vtkm')
  and is_class and starts_with(module_name, 'vtk')""")
def flt1(spark, sf):
    return FL.inventory_filter(V(spark, sf, "v_inventory")).select("module_name", "class_name")


@query("flt2_boilerplate_filter", duck_with("v_methods") + f"""
select class_name, method_name, is_callable from v_methods where not {O.boilerplate_sql('method_name')}""")
def flt2(spark, sf):
    return FL.drop_boilerplate(V(spark, sf, "v_methods"))


@query("flt3_doc_line_filter", _PARSE + f"select module_name, class_name, pos, line from lines where not {O.cpp('line')}")
def flt3(spark, sf):
    from docsmith.functions.text import is_cpp_line
    return hp.explode_lines(_help(spark, sf)).filter(~is_cpp_line("line")).drop(hp.DOC_ID)


@query("flt4_page_line_filter", _PARSE + f"select module_name, class_name, pos, line from lines where not {O.page_noise('line')}")
def flt4(spark, sf):
    from docsmith.functions.text import is_page_noise_line
    return hp.explode_lines(_help(spark, sf)).filter(~is_page_noise_line("line")).drop(hp.DOC_ID)


@query("flt5_cacheable", duck_with("v_records") + """
select class_name, seq from v_records where synopsis <> '' or action_phrase <> ''""")
def flt5(spark, sf):
    return FL.cacheable(V(spark, sf, "v_records")).select("class_name", "seq")


@query("flt6_labelable", duck_with("v_records") + f"""
select class_name, seq from v_records where class_doc is not null and {O.strip('class_doc')} <> ''""")
def flt6(spark, sf):
    r = V(spark, sf, "v_records")
    return r.filter(FL.is_labelable("class_doc")).select("class_name", "seq")


@query("flt7_search_predicate", duck_with("v_records") + """
select class_name, seq from v_records where contains(lower(synopsis), 'in en')""")
def flt7(spark, sf):
    r = V(spark, sf, "v_records")
    return r.filter(FL.search_predicate(r, "synopsis", "IN EN")).select("class_name", "seq")


@query("flt7_search_unknown_field", duck_with("v_records") + "select class_name, seq from v_records")
def flt7_unknown(spark, sf):
    r = V(spark, sf, "v_records")
    return r.filter(FL.search_predicate(r, "no_such_field", "")).select("class_name", "seq")


@query("flt8_annotatable", duck_with("v_records") + """
select module_name, class_name, seq from v_records where class_doc is not null and class_doc <> ''""")
def flt8(spark, sf):
    return FL.annotatable(V(spark, sf, "v_records")).select("module_name", "class_name", "seq")


# --------------------------------------------------------------------------
# CLS
# --------------------------------------------------------------------------

_HIER = duck_with("v_classes", "v_bases", recursive=True)


@query("cls1_isa_closure", _HIER + """,
isa(class_name, ancestor) as (
  select class_name, class_name from v_classes
  union
  select i.class_name, b.base_name from isa i join v_bases b on b.class_name = i.ancestor)
select class_name, ancestor from isa""")
def cls1(spark, sf):
    return HY.isa_closure(V(spark, sf, "v_classes"), V(spark, sf, "v_bases"))


@query("cls2_role", _HIER + "," + O.facts_ctes("select class_name from v_classes") + f"""
select class_name, {O.role_case()} as role from facts""")
def cls2(spark, sf):
    classes = V(spark, sf, "v_classes")
    flags = HY.isa_flags(V(spark, sf, "v_bases"))
    return HY.roles(classes.select("class_name"), classes, flags)


_PORTS = duck_with("v_classes", "v_bases", "v_ports", recursive=True)


@query("cls3_port_datatypes", _PORTS + "," + O.facts_ctes("select class_name from v_classes") + "," + O.port0_cte() + f"""
select f.class_name, {O.datatypes_sql()[0]} as input_datatype, {O.datatypes_sql()[1]} as output_datatype
from facts f left join port0 p on p.class_name = f.class_name""")
def cls3(spark, sf):
    classes = V(spark, sf, "v_classes")
    flags = HY.isa_flags(V(spark, sf, "v_bases"))
    ports = HY.ports_from_text(V(spark, sf, "v_ports"))
    return HY.datatypes(classes.select("class_name"), classes, flags, ports)


@query("cls4_datatype_normalise", duck_with("v_ports") + f"""
select class_name, direction, port, {O.norm_types('types')} as datatype from v_ports""")
def cls4(spark, sf):
    ports = HY.ports_from_text(V(spark, sf, "v_ports"))
    return ports.select("class_name", "direction", "port", HY.normalize_types("types").alias("datatype"))


@query("cls5_semantic_methods", duck_with("v_methods", "v_classes") + "," + O.semantic_cte("v_methods") + """
select c.class_name, coalesce(s.semantic, '') as semantic_methods, cast(coalesce(s.n_sem, 0) as bigint) as n_methods
from (select distinct class_name from v_methods) c left join sem s on s.class_name = c.class_name and c.class_name in (select class_name from v_classes)""")
def cls5(spark, sf):
    cm = V(spark, sf, "v_methods")
    sem = HY.semantic_methods(cm, V(spark, sf, "v_classes"))
    return cm.select("class_name").distinct().join(sem, "class_name", "left").select(
        "class_name",
        F.coalesce(F.array_join("semantic_methods", ","), F.lit("")).alias("semantic_methods"),
        F.coalesce(F.size("semantic_methods"), F.lit(0)).cast("bigint").alias("n_methods"),
    )


_PROFILE_SQL = (
    duck_with("v_classes", "v_bases", "v_ports", "v_methods", recursive=True) + ","
    + O.facts_ctes("select class_name from v_classes union select class_name from v_methods") + ","
    + O.port0_cte() + "," + O.semantic_cte("v_methods") + f""",
roled as (select *, {O.role_case()} as role from facts),
profile as (
  select f.class_name, f.role, {O.datatypes_sql()[0]} as input_datatype,
    {O.datatypes_sql()[1]} as output_datatype, case when f.known then coalesce(s.semantic, '') else '' end as semantic_methods
  from roled f left join port0 p on p.class_name = f.class_name left join sem s on s.class_name = f.class_name)
""")


def _profile(spark, sf):
    return CT.catalog_profile(V(spark, sf, "v_classes"), V(spark, sf, "v_bases"),
                              HY.ports_from_text(V(spark, sf, "v_ports")), V(spark, sf, "v_methods"))


@query("cls6_profile", _PROFILE_SQL + "select class_name, role, input_datatype, output_datatype, semantic_methods from profile")
def cls6(spark, sf):
    return _profile(spark, sf).withColumn("semantic_methods", F.array_join("semantic_methods", ","))


@query("ord1_sorted_methods", duck_with("v_help_methods") + "," + O.semantic_cte("v_help_methods")
       + "select class_name, semantic as semantic_methods from sem")
def ord1(spark, sf):
    return HY.semantic_methods(V(spark, sf, "v_help_methods")).select(
        "class_name", F.array_join("semantic_methods", ",").alias("semantic_methods"))


@query("ord2_key_methods", duck_with("v_methods") + "," + O.semantic_cte("v_methods") + """,
ranked as (select class_name, method_name, row_number() over (partition by class_name order by method_name) as rn
  from (select distinct class_name, method_name from v_methods where is_callable and not """
       + O.boilerplate_sql("method_name") + """))
select class_name, '## Key Methods' || chr(10) || chr(10) || string_agg(case when rn <= 20 then '`' || method_name || '`' end, ', ' order by method_name) || chr(10)
  || case when count(*) > 20 then chr(10) || '*...and ' || (count(*) - 20) || ' more*' || chr(10) else '' end as part
from ranked group by class_name""")
def ord2(spark, sf):
    # the "Key Methods" part of a page, as rendered
    sem = HY.semantic_methods(V(spark, sf, "v_methods"))
    return sem.select("class_name", F.array_join(PG.key_method_lines(F.col("semantic_methods")), "\n").alias("part"))


# --------------------------------------------------------------------------
# Labels: SRC3, JN1-JN4, SET1, AGG6/7, SCL1-8, UDF1
# --------------------------------------------------------------------------

_CACHE_LATEST = """
cache_latest as (
  select class_name, arg_max(synopsis, seq) as synopsis, arg_max(action_phrase, seq) as action_phrase,
    arg_max(visibility_score, seq) as visibility_score
  from v_cache group by class_name)
"""


def _cache(spark, sf):
    return LL.dedupe_label_cache(V(spark, sf, "v_cache"), "seq")


@query("src3_label_cache_last_wins", duck_with("v_cache") + "," + _CACHE_LATEST + "select * from cache_latest")
def src3(spark, sf):
    return _cache(spark, sf)


@query("jn1_record_profile", _PROFILE_SQL + ", " + duck_with("v_records")[5:] + """
select r.class_name, r.seq, coalesce(p.role, 'utility') as role, coalesce(p.input_datatype, '') as input_datatype,
  coalesce(p.output_datatype, '') as output_datatype, coalesce(p.semantic_methods, '') as semantic_methods
from v_records r left join profile p on p.class_name = r.class_name""")
def jn1(spark, sf):
    recs = CT.attach_profile(V(spark, sf, "v_records"), _profile(spark, sf))
    return recs.select("class_name", "seq", "role", "input_datatype", "output_datatype",
                       F.array_join("semantic_methods", ",").alias("semantic_methods"))


@query("jn2_cache_hit", duck_with("v_records", "v_cache") + """
select class_name, seq from v_records r where exists (select 1 from v_cache c where c.class_name = r.class_name)""")
def jn2(spark, sf):
    return LL.cache_hits(V(spark, sf, "v_records"), V(spark, sf, "v_cache")).select("class_name", "seq")


@query("jn3_cache_miss", duck_with("v_records", "v_cache") + """
select class_name, seq from v_records r where not exists (select 1 from v_cache c where c.class_name = r.class_name)""")
def jn3(spark, sf):
    return LL.cache_misses(V(spark, sf, "v_records"), V(spark, sf, "v_cache")).select("class_name", "seq")


@query("jn4_apply_labels", duck_with("v_records", "v_cache") + "," + _CACHE_LATEST + """
select r.class_name, r.seq, coalesce(c.synopsis, '') as synopsis, coalesce(c.action_phrase, '') as action_phrase,
  coalesce(c.visibility_score, 0.3) as visibility_score, c.class_name is not null as matched
from v_records r left join cache_latest c on c.class_name = r.class_name""")
def jn4(spark, sf):
    out = LL.apply_labels(V(spark, sf, "v_records"), _cache(spark, sf))
    return out.select("class_name", "seq", "synopsis", "action_phrase", "visibility_score", "matched")


@query("agg6_label_coverage", duck_with("v_records", "v_cache") + """
select cast(count(*) filter (where exists (select 1 from v_cache c where c.class_name = r.class_name)) as bigint) as classified,
  cast(count(*) as bigint) as total from v_records r""")
def agg6(spark, sf):
    return LL.label_coverage(LL.apply_labels(V(spark, sf, "v_records"), _cache(spark, sf)))


@query("agg7_cache_usage", duck_with("v_records", "v_cache") + """,
hit as (select r.class_name, exists (select 1 from v_cache c where c.class_name = r.class_name) as h from v_records r)
select cast(count(distinct class_name) filter (where h) as bigint) as cached_classes,
  cast(count(*) filter (where not h) as bigint) as uncached_requests,
  cast(count(distinct class_name) filter (where not h) as bigint) as uncached_classes from hit""")
def agg7(spark, sf):
    return LL.cache_usage(V(spark, sf, "v_records"), V(spark, sf, "v_cache"))


def _fence_sql(x: str) -> str:
    s = O.strip(x)
    head = (f"case when starts_with({s}, '```') then (case when contains({s}, {NL}) "
            f"then substring({s}, strpos({s}, {NL}) + 1) else substring({s}, 4) end) else {s} end")
    return O.strip(f"(case when ends_with({head}, '```') then left({head}, length({head}) - 3) else {head} end)")


_RESP_PARSED = duck_with("v_resp") + f""",
f as (select class_name, content, {_fence_sql('content')} as body from v_resp),
j as (select *, try_cast(body as json) as js from f),
k as (select *, coalesce(json_type(js) = 'OBJECT', false) as is_obj,
   json_type(js, '$.synopsis') as syn_t, js ->> '$.synopsis' as syn_s,
   json_type(js, '$.visibility') as vis_t, json_type(js, '$.visibility_score') as vs_t,
   json_type(js, '$.action_phrase') as act_t
  from j),
l as (select *,
   coalesce(case when vis_t is null or vis_t = 'NULL' then false
        when vis_t = 'BOOLEAN' then (js ->> '$.visibility') = 'true'
        when vis_t in ('UBIGINT', 'BIGINT', 'DOUBLE') then cast(js ->> '$.visibility' as double) <> 0
        when vis_t = 'VARCHAR' then length(js ->> '$.visibility') > 0
        else (js ->> '$.visibility') not in ('[]', '{{}}') end, false) as vis_truthy
  from k),
m as (select *,
   case when vis_truthy then vis_t else vs_t end as ch_t,
   case when vis_truthy then js ->> '$.visibility' else js ->> '$.visibility_score' end as ch_s,
   regexp_replace({O.strip('syn_s')}, '\\A["'']+|["'']+\\z', '', 'g') as syn_c
  from l),
parsed as (select class_name,
   (content is not null and content <> '' and js is not null and is_obj and (syn_t is null or syn_t = 'VARCHAR')) as is_label,
   case when syn_t is null then null when syn_c <> '' and not ends_with(syn_c, '.') then syn_c || '.' else syn_c end as synopsis,
   case when act_t is null then '' when act_t = 'NULL' then null when act_t = 'VARCHAR' then js ->> '$.action_phrase'
        else json_extract(js, '$.action_phrase')::varchar end as action_phrase,
   case when ch_t = 'BOOLEAN' then (case when ch_s = 'true' then 1.0 else 0.0 end)
        when ch_t in ('UBIGINT', 'BIGINT', 'DOUBLE') then least(1.0, greatest(0.0, cast(ch_s as double)))
        else 0.3 end as visibility_score,
   body
  from m)
"""


@query("scl3_fence_strip", _RESP_PARSED + "select class_name, body from parsed")
def scl3(spark, sf):
    return V(spark, sf, "v_resp").select("class_name", LB.strip_code_fence("content").alias("body"))


@query("scl4_json_parse", _RESP_PARSED + "select class_name, is_label from parsed")
def scl4(spark, sf):
    return LB.parse_label(V(spark, sf, "v_resp")).select("class_name", "is_label")


@query("scl5_synopsis", _RESP_PARSED + "select class_name, synopsis, action_phrase from parsed where is_label")
def scl5(spark, sf):
    return LL.parse_responses(V(spark, sf, "v_resp")).select("class_name", "synopsis", "action_phrase")


@query("scl6_score", _RESP_PARSED + "select class_name, cast(visibility_score as double) as visibility_score from parsed where is_label")
def scl6(spark, sf):
    return LL.parse_responses(V(spark, sf, "v_resp")).select("class_name", "visibility_score")


@query("set1_labels_union", duck_with("v_records", "v_cache") + "," + _CACHE_LATEST + "," + _RESP_PARSED[5:] + f""",
todo as (select class_name, arg_max(class_doc, seq) as class_doc from v_records r
  where not exists (select 1 from v_cache c where c.class_name = r.class_name) group by class_name)
select class_name, synopsis, action_phrase, visibility_score from cache_latest
where class_name in (select class_name from v_records)
union all
select p.class_name, p.synopsis, p.action_phrase, cast(p.visibility_score as double) from parsed p
join todo t on t.class_name = p.class_name
where p.is_label and t.class_doc is not null and {O.strip('t.class_doc')} <> ''""")
def set1(spark, sf):
    return LL.label_classes(V(spark, sf, "v_records"), _cache(spark, sf), responses=V(spark, sf, "v_resp"),
                            order_col="seq")


@query("job2_label", duck_with("v_records", "v_cache") + "," + _CACHE_LATEST + "," + _RESP_PARSED[5:] + f""",
todo as (select class_name, arg_max(class_doc, seq) as class_doc from v_records r
  where not exists (select 1 from v_cache c where c.class_name = r.class_name) group by class_name),
labels as (
  select class_name, synopsis, action_phrase, visibility_score from cache_latest
  union all
  select p.class_name, p.synopsis, p.action_phrase, cast(p.visibility_score as double) from parsed p
  join todo t on t.class_name = p.class_name
  where p.is_label and t.class_doc is not null and {O.strip('t.class_doc')} <> '')
select r.class_name, r.seq, coalesce(l.synopsis, '') as synopsis, coalesce(l.action_phrase, '') as action_phrase,
  coalesce(l.visibility_score, 0.3) as visibility_score, l.class_name is not null as matched
from v_records r left join labels l on l.class_name = r.class_name""")
def job2(spark, sf):
    recs = V(spark, sf, "v_records")
    labels = LL.label_classes(recs, _cache(spark, sf), responses=V(spark, sf, "v_resp"), order_col="seq")
    return LL.apply_labels(recs, labels).select(
        "class_name", "seq", "synopsis", "action_phrase", "visibility_score", "matched")


def _trunc_sql(x: str) -> str:
    return f"case when length({x}) > 2000 then substring({x}, 1, 2000) || '...' else {x} end"


@query("udf1_default_labeller", duck_with("v_records", "v_cache") + "," + _CACHE_LATEST + f""",
todo as (select class_name, arg_max(class_doc, seq) as class_doc from v_records r
  where not exists (select 1 from v_cache c where c.class_name = r.class_name) group by class_name)
select class_name, synopsis, action_phrase, visibility_score from cache_latest
where class_name in (select class_name from v_records)
union all
select class_name, class_name || ' docs.', 'reading', cast((length({_trunc_sql('class_doc')}) % 100) / 100.0 as double)
from todo where class_doc is not null and {O.strip('class_doc')} <> ''""")
def udf1(spark, sf):
    return LL.label_classes(V(spark, sf, "v_records"), _cache(spark, sf), labeller=LL.default_labeller,
                            order_col="seq", concurrency=4)


@query("scl1_truncate", duck_with("v_records") + f"select class_name, seq, {_trunc_sql('class_doc')} as doc from v_records")
def scl1(spark, sf):
    return V(spark, sf, "v_records").select("class_name", "seq", truncate_doc("class_doc").alias("doc"))


@query("scl2_prompt", duck_with("v_records") + f"""
select class_name, seq, {O.sql_lit(LB.PROMPT_HEAD)} || class_name || {O.sql_lit(LB.PROMPT_MID)}
  || {_trunc_sql('class_doc')} || {O.sql_lit(LB.PROMPT_TAIL)} as prompt from v_records""")
def scl2(spark, sf):
    return V(spark, sf, "v_records").select("class_name", "seq", LB.prompt("class_name", "class_doc").alias("prompt"))


@query("scl7_stars", duck_with("v_cache") + """
select class_name, seq, repeat('⭐', cast(greatest(round_even(visibility_score * 5, 0), 0) as bigint)) as stars from v_cache""")
def scl7(spark, sf):
    return V(spark, sf, "v_cache").select("class_name", "seq", stars("visibility_score").alias("stars"))


@query("scl8_score_text", duck_with("v_records") + """
select class_name, seq, printf('%.1f', visibility_score) as score_text from v_records""")
def scl8(spark, sf):
    return V(spark, sf, "v_records").select("class_name", "seq", one_decimal("visibility_score").alias("score_text"))


@query("scl12_thousands", duck_with("v_records") + """
select class_name, seq, format('{:,}', seq * 9973) as formatted from v_records""")
def scl12(spark, sf):
    return V(spark, sf, "v_records").select("class_name", "seq", thousands(F.col("seq") * 9973).alias("formatted"))


@query("scl10_method_doc_format", _PARSE + f"""
select module_name, class_name, section, method,
  case when doc is null or doc = '' or {O.strip('doc')} = '.' then '*No documentation available.*'
       else coalesce(nullif(array_to_string(list_transform(list_filter(string_split({O.strip('doc')}, {NL}),
              lambda l: not {O.page_noise('l')}), lambda l: {O.strip('l')}), {NL}), ''), '*No documentation available.*') end as formatted
from resolved""")
def scl10(spark, sf):
    _, methods = hp.parse_help(_help(spark, sf))
    return methods.select(*hp.DOC_KEYS, "section", "method", format_method_doc("doc").alias("formatted"))


@query("scl11_section_label", _PARSE + f"""
select module_name, class_name, pos, {O.strip("replace(sec_name, '|', '')")} as label from m2 where is_hdr""")
def scl11(spark, sf):
    m = hp.mark_lines(hp.explode_lines(_help(spark, sf)))
    return m.filter("is_hdr").select(*hp.DOC_KEYS, "pos", section_label("sec_name").alias("label"))
