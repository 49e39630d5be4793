"""Registered queries for the composed jobs (JOB1-JOB9) and the operators
they are built from (JN5-JN7, AGG1, AGG2, AGG4, AGG5, AGG8, AGG9, ORD3, ORD4,
SET2, SCL9)."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.operators import catalog as CT
from docsmith.operators import helpparse as hp
from docsmith.operators import hierarchy as HY
from docsmith.operators import labelling as LL
from docsmith.operators import pages as PG
from docsmith.operators import stubs as SB
from docsmith.plans import oracle as O
from docsmith.plans.queries import query
from docsmith.plans.views import VIEW_SQL, duck_with, render, spark_view
from docsmith.schema import RECORD
from docsmith.sources import files as FS
from docsmith.sources import io as IO

NL = O.NL


def V(spark, sf, name):
    return spark_view(spark, name, sf)


def _views(*names):
    """View definitions to continue an existing WITH list."""
    return ",\n".join(f"{n} as ({render(VIEW_SQL[n], 'duckdb')})" for n in names)


def _profile_ctes(methods_view: str) -> str:
    return (
        O.facts_ctes(f"select class_name from v_classes union select class_name from {methods_view}") + ","
        + O.port0_cte() + "," + O.semantic_cte(methods_view) + f""",
roled as (select *, {O.role_case()} as role from facts),
profile as (
  select f.class_name, f.role, {O.datatypes_sql()[0]} as input_datatype,
    {O.datatypes_sql()[1]} as output_datatype, case when f.known then coalesce(s.semantic, '') else '' end as semantic_methods
  from roled f left join port0 p on p.class_name = f.class_name left join sem s on s.class_name = f.class_name)
""")


_CACHE_LATEST = """
cache_latest as (
  select class_name, arg_max(synopsis, seq) as synopsis, arg_max(action_phrase, seq) as action_phrase,
    arg_max(visibility_score, seq) as visibility_score
  from v_cache group by class_name)
"""

def _catalog_sql(dump: str, more: str = "") -> str:
    """Help dump ``dump`` (a view, or one of ``more``'s) parsed, profiled against
    the catalog views and labelled from the cache."""
    return (
    "with recursive " + _views("v_help", "v_classes", "v_bases", "v_ports", "v_help_methods", "v_cache") + more + ","
    + O.parse_ctes(dump) + "," + _profile_ctes("v_help_methods") + "," + _CACHE_LATEST + f""",
sec_counts as (select module_name, class_name, count(distinct section) as n_sections, count(*) as n_methods
  from resolved group by module_name, class_name),
catalog as (
  select c.module_name, c.class_name, c.class_doc,
    coalesce(p.role, 'utility') as role, coalesce(p.input_datatype, '') as input_datatype,
    coalesce(p.output_datatype, '') as output_datatype, coalesce(p.semantic_methods, '') as semantic_methods,
    coalesce(l.synopsis, '') as synopsis, coalesce(l.action_phrase, '') as action_phrase,
    coalesce(l.visibility_score, 0.3) as visibility_score, l.class_name is not null as matched,
    cast(coalesce(s.n_sections, 0) as bigint) as n_sections, cast(coalesce(s.n_methods, 0) as bigint) as n_methods
  from cdocs c left join profile p on p.class_name = c.class_name
  left join cache_latest l on l.class_name = c.class_name
  left join sec_counts s on s.module_name = c.module_name and s.class_name = c.class_name)
""")


_CATALOG_SQL = _catalog_sql("v_help")


def _catalog(spark, sf):
    prof = CT.catalog_profile(V(spark, sf, "v_classes"), V(spark, sf, "v_bases"),
                              HY.ports_from_text(V(spark, sf, "v_ports")), V(spark, sf, "v_help_methods"))
    labels = LL.dedupe_label_cache(V(spark, sf, "v_cache"), "seq")
    return CT.build_catalog(V(spark, sf, "v_help"), prof, labels)


@query("job1_build_catalog", _CATALOG_SQL + "select * from catalog")
def job1(spark, sf):
    secs = F.col("structured_docs.sections")
    return _catalog(spark, sf).select(
        "module_name", "class_name", "class_doc", "role", "input_datatype", "output_datatype",
        F.array_join("semantic_methods", ",").alias("semantic_methods"),
        "synopsis", "action_phrase", "visibility_score", "matched",
        F.size(F.map_keys(secs)).cast("bigint").alias("n_sections"),
        CT.record_method_count().alias("n_methods"),
    )


_STATS_SQL = "with " + _views("v_help") + "," + O.parse_ctes("v_help") + """
select cast(count(*) as bigint) as total_records, cast(count(distinct module_name) as bigint) as modules,
  cast((select count(*) from resolved) as bigint) as total_methods from cdocs"""


@query("agg4_stats", _STATS_SQL)
def agg4(spark, sf):
    return CT.help_stats(V(spark, sf, "v_help"))


@query("job8_stats", _STATS_SQL.replace(" as total_methods", " as total_methods, true as size_is_that_of_the_lines"))
def job8(spark, sf):
    """Statistics of the records in the JSON sink; their size against the bytes of their lines."""
    path = _scratch(spark, "records")
    IO.write_records(CT.build_catalog(V(spark, sf, "v_help"), profile=None), path)
    line_bytes = spark.read.text(path).agg(F.sum(F.octet_length("value") + 1)).scalar()
    return CT.database_stats(IO.read_records(spark, path), path).select(
        "total_records", "modules", "total_methods",
        (F.col("size_mib") * 1048576 == line_bytes).alias("size_is_that_of_the_lines"))


# --------------------------------------------------------------------------
# Pages
# --------------------------------------------------------------------------

def _meta_sql(role, action, score, inp, out) -> str:
    rows = (f"list_filter([case when {role} <> '' then '| **Role** | ' || {role} || ' |' end, "
            f"case when {action} <> '' then '| **Action** | ' || {action} || ' |' end, "
            f"case when {score} > 0 then '| **Visibility** | ' || repeat('⭐', cast(greatest(round_even({score} * 5, 0), 0) as bigint)) "
            f"|| ' (' || printf('%.1f', {score}) || ') |' end, "
            f"case when {inp} <> '' then '| **Input Type** | ' || {inp} || ' |' end, "
            f"case when {out} <> '' then '| **Output Type** | ' || {out} || ' |' end], lambda x: x is not null)")
    return f"(case when len({rows}) > 0 then ['| | |', '|---|---|'] || {rows} || [''] else [] end)"


def _keys_sql(sem_list: str) -> str:
    shown = f"array_to_string(list_transform({sem_list}[1:20], lambda m: '`' || m || '`'), ', ')"
    more = f"(case when len({sem_list}) > 20 then [{NL} || '*...and ' || (len({sem_list}) - 20) || ' more*'] else [] end)"
    return f"(case when len({sem_list}) > 0 then ['## Key Methods', '', {shown}] || {more} || [''] else [] end)"


def _fmt_sql(x: str) -> str:
    return (f"(case when {x} is null or {x} = '' or {O.strip(x)} = '.' then '*No documentation available.*' "
            f"else coalesce(nullif(array_to_string(list_transform(list_filter(string_split({O.strip(x)}, {NL}), "
            f"lambda l: not {O.page_noise('l')}), lambda l: {O.strip('l')}), {NL}), ''), '*No documentation available.*') end)")


_PAGES_CTES = f""",
sem_list as (select class_name, list(method_name order by method_name) as sem
  from (select distinct class_name, method_name from v_help_methods where is_callable and not {O.boilerplate_sql('method_name')}
        and class_name in (select class_name from v_classes))
  group by class_name),
key_methods as (
  select r.module_name, r.class_name, r.section, r.sec_ord, r.method, r.doc from resolved r
  join sem_list s on s.class_name = r.class_name where list_contains(s.sem, r.method)),
sec_blocks as (
  select module_name, class_name, sec_ord,
    ['### ' || {O.strip("replace(section, '|', '')")}, ''] ||
      flatten(list(['#### `' || method || '`', '', {_fmt_sql('doc')}, ''] order by method)) as lines
  from key_methods group by module_name, class_name, section, sec_ord),
methods_part as (
  select module_name, class_name, flatten(list(lines order by sec_ord)) as lines
  from sec_blocks group by module_name, class_name),
pages as (
  select c.module_name, c.class_name, c.module_name || '/' || c.class_name || '.md' as path,
    array_to_string(
      ['# ' || c.class_name, '', '**Module:** `vtkmodules.' || c.module_name || '`', '']
      || {_meta_sql('c.role', 'c.action_phrase', 'c.visibility_score', 'c.input_datatype', 'c.output_datatype')}
      || (case when c.synopsis <> '' then ['## Synopsis', '', c.synopsis, ''] else [] end)
      || (case when c.class_doc <> '' then ['## Description', '', c.class_doc, ''] else [] end)
      || {_keys_sql("coalesce(s.sem, [])")}
      || (case when c.n_sections > 0 and len(coalesce(s.sem, [])) > 0
               then ['## Methods', ''] || coalesce(m.lines, []) else [] end),
      {NL}) as content
  from catalog c left join sem_list s on s.class_name = c.class_name
  left join methods_part m on m.module_name = c.module_name and m.class_name = c.class_name)
"""
_PAGES_SQL = _CATALOG_SQL + _PAGES_CTES

# The files of a page folder: pages, module indexes, main index.
_PAGE_FILES_CTES = f""",
per_module as (select module_name, count(*) as n, string_agg('- [`' || class_name || '`](' || class_name || '.md)'
    || case when synopsis <> '' then ' - ' || synopsis else '' end, {NL} order by class_name) as bullets from catalog group by module_name),
page_files as (
  select path, content from pages
  union all select module_name || '/index.md', '# ' || module_name || {NL} || {NL} || '**' || n || ' classes**' || {NL} || {NL} || '## Classes' || {NL} || {NL} || bullets from per_module
  union all select 'index.md', '# VTK Python API Documentation' || {NL} || {NL} || '**VTK (version unknown)**' || {NL} || {NL}
    || 'This documentation covers ' || count(*) || ' modules with ' || format('{{:,}}', cast(sum(n) as bigint)) || ' classes.' || {NL} || {NL} || '## Modules' || {NL} || {NL}
    || string_agg('- [' || module_name || '](' || module_name || '/index.md) (' || n || ' classes)', {NL} order by module_name) from per_module)
"""


@query("jn7_section_semantic_semi", _PAGES_SQL + f"""
select c.module_name, c.class_name, array_to_string(case when c.n_sections > 0 and len(coalesce(s.sem, [])) > 0
  then ['## Methods', ''] || coalesce(m.lines, []) else [] end, {NL}) as part
from catalog c left join sem_list s on s.class_name = c.class_name
left join methods_part m on m.module_name = c.module_name and m.class_name = c.class_name""")
def jn7(spark, sf):
    # the "Methods" part of a page: the sections' methods that are semantic, as rendered
    part = PG.method_section_lines(F.col("structured_docs.sections"), F.col("semantic_methods"))
    return _catalog(spark, sf).select("module_name", "class_name", F.array_join(part, "\n").alias("part"))


@query("job4_class_pages", _PAGES_SQL + "select module_name, class_name, path, content from pages")
def job4(spark, sf):
    return PG.class_page(_catalog(spark, sf))


_REC_PROFILE_SQL = (
    "with recursive " + _views("v_records", "v_classes", "v_bases", "v_ports", "v_methods") + ","
    + _profile_ctes("v_methods") + """,
recs as (
  select r.*, coalesce(p.role, 'utility') as role, coalesce(p.input_datatype, '') as input_datatype,
    coalesce(p.output_datatype, '') as output_datatype, coalesce(p.semantic_methods, '') as semantic_methods
  from v_records r left join profile p on p.class_name = r.class_name)
""")


def _profiled_records(spark, sf):
    prof = CT.catalog_profile(V(spark, sf, "v_classes"), V(spark, sf, "v_bases"),
                              HY.ports_from_text(V(spark, sf, "v_ports")), V(spark, sf, "v_methods"))
    return CT.attach_profile(V(spark, sf, "v_records"), prof)


@query("scl9_metadata_table", _REC_PROFILE_SQL + f"""
select class_name, seq, array_to_string({_meta_sql('role', 'action_phrase', 'visibility_score', 'input_datatype', 'output_datatype')}, {NL}) as metadata
from recs""")
def scl9(spark, sf):
    return _profiled_records(spark, sf).select(
        "class_name", "seq", F.array_join(PG.metadata_lines(), "\n").alias("metadata"))


@query("job4_record_pages", _REC_PROFILE_SQL + f"""
select module_name, class_name, seq, array_to_string(
  ['# ' || class_name, '', '**Module:** `vtkmodules.' || module_name || '`', '']
  || {_meta_sql('role', 'action_phrase', 'visibility_score', 'input_datatype', 'output_datatype')}
  || (case when synopsis <> '' then ['## Synopsis', '', synopsis, ''] else [] end)
  || (case when class_doc <> '' then ['## Description', '', class_doc, ''] else [] end)
  || {_keys_sql("case when semantic_methods = '' then [] else string_split(semantic_methods, ',') end")}, {NL}) as content
from recs""")
def job4_records(spark, sf):
    page = PG.class_page(_profiled_records(spark, sf), keep=("seq",))
    return page.select("module_name", "class_name", "seq", "content")


@query("agg2_latest_per_class", duck_with("v_records") + """
select module_name, class_name, max(seq) as seq, arg_max(synopsis, seq) as synopsis
from v_records group by module_name, class_name""")
def agg2(spark, sf):
    return LL.latest_per_key(V(spark, sf, "v_records").select("module_name", "class_name", "seq", "synopsis"),
                             ["module_name", "class_name"], "seq")


_INDEX_SQL = duck_with("v_records") + """,
latest as (select module_name, class_name, arg_max(synopsis, seq) as synopsis
  from v_records group by module_name, class_name),
counts as (select module_name, count(*) as n from latest group by module_name)
"""


@query("job5_module_index", _INDEX_SQL + """,
lines as (
select module_name, 0 as kind, '00' as sort_key, '# ' || module_name as line from counts
union all select module_name, 0, '01', '' from counts
union all select module_name, 0, '02', '**' || n || ' classes**' from counts
union all select module_name, 0, '03', '' from counts
union all select module_name, 0, '04', '## Classes' from counts
union all select module_name, 0, '05', '' from counts
union all select module_name, 1, class_name, '- [`' || class_name || '`](' || class_name || '.md)'
  || case when synopsis <> '' then ' - ' || synopsis else '' end from latest)
select module_name, module_name || '/index.md' as path, kind, sort_key, line from lines""")
def job5(spark, sf):
    return PG.module_index_lines(V(spark, sf, "v_records"), "seq")


# records of some modules whose score is an explicit null: their pages fail
_FAILS = "length(module_name) % 3 = 0 and seq % 50 = 1"
_RESULTS_SQL = duck_with("v_records") + f""",
cur as (select module_name, class_name, arg_max({_FAILS}, class_doc) as failed from v_records group by module_name, class_name),
res as (select module_name, case when bool_or(failed) then 'error' else 'success' end as status,
  cast(case when bool_or(failed) then 0 else count(*) end as bigint) as class_count,
  'visibility_score is null: ' || min(case when failed then class_name end) as error from cur group by module_name)
"""


def _results(spark, sf):
    return PG.module_results(V(spark, sf, "v_records").withColumn("score_null", F.expr(_FAILS)))


@query("agg8_module_results", _RESULTS_SQL + "select module_name, status, class_count, error from res")
def agg8_results(spark, sf):
    return _results(spark, sf)


def _scratch(spark, name):
    import uuid

    from docsmith.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("src1_record_file_results", duck_with("v_records") + """,
cur as (select module_name, class_name, arg_max(seq % 50 = 1, class_doc) as failed from v_records group by module_name, class_name)
select module_name, case when bool_or(failed) then 'error' else 'success' end as status,
  cast(case when bool_or(failed) then 0 else count(*) end as bigint) as class_count,
  'visibility_score is null: ' || min(case when failed then class_name end) as error
from cur group by module_name""")
def src1(spark, sf):
    """Records read back from JSON lines: with a score, with an explicit null
    (the page fails) and without one (the default)."""
    recs = V(spark, sf, "v_records")
    own = ["module_name", "class_name", "class_doc", "synopsis"]
    full, bare = F.to_json(F.struct(*own, "visibility_score")), F.to_json(F.struct(*own))
    null = F.to_json(F.struct(*own, F.lit(None).cast("double").alias("visibility_score")), {"ignoreNullFields": "false"})
    path = _scratch(spark, "records")
    recs.select(F.when(F.col("seq") % 50 == 1, null).when(F.col("seq") % 3 == 0, bare).otherwise(full)).write.text(path)
    return PG.module_results(IO.read_records(spark, path, with_flags=True))


@query("snk1_record_round_trip", duck_with("v_records") + """
select module_name, class_name, class_doc, synopsis, action_phrase, visibility_score from v_records""")
def snk1(spark, sf):
    path = _scratch(spark, "records")
    recs = V(spark, sf, "v_records")
    missing = [f for f in RECORD.fields if f.name not in recs.columns]
    IO.write_records(recs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]), path)
    return IO.read_records(spark, path).select("module_name", "class_name", "class_doc", "synopsis", "action_phrase", "visibility_score")


@query("snk2_label_cache_round_trip", duck_with("v_cache") + """
select class_name, arg_max(synopsis, seq) as synopsis, arg_max(action_phrase, seq) as action_phrase,
  arg_max(visibility_score, seq) as visibility_score from v_cache group by class_name""")
def snk2(spark, sf):
    path = _scratch(spark, "cache")
    IO.write_label_cache(LL.dedupe_label_cache(V(spark, sf, "v_cache"), "seq"), path)
    return IO.read_label_cache(spark, path, missing_ok=False).select("class_name", "synopsis", "action_phrase", "visibility_score")


@query("snk3_stub_round_trip", duck_with("v_stubs") + """
select module_name, module_name || '.pyi' as path, content from v_stubs""")
def snk3(spark, sf):
    path = _scratch(spark, "stubs")
    IO.write_stubs(V(spark, sf, "v_stubs").withColumn("path", F.concat("module_name", F.lit(".pyi"))), path)
    return spark.read.parquet(path).select("module_name", "path", "content")


@query("src4_help_dump_round_trip", duck_with("v_help") + """
select module_name, class_name, help_text from v_help""")
def src4_round_trip(spark, sf):
    path = _scratch(spark, "help")
    V(spark, sf, "v_help").write.parquet(path)
    return IO.read_help_dump(spark, path)


@query("agg8_build_summary", _RESULTS_SQL + """
select cast(count(*) filter (where status = 'success') as bigint) as modules_ok, cast(count(*) as bigint) as modules_total,
  cast(sum(class_count) as bigint) as classes_total from res""")
def agg8(spark, sf):
    return PG.build_summary(_results(spark, sf))


@query("job6_main_index", _RESULTS_SQL + """,
ok as (select module_name, class_count as n from res where status = 'success'),
tot as (select count(*) as m, coalesce(sum(n), 0) as c from ok),
lines as (
select 0 as kind, '00' as sort_key, '# VTK Python API Documentation' as line
union all select 0, '01', ''
union all select 0, '02', '**VTK (version unknown)**'
union all select 0, '03', ''
union all select 0, '04', 'This documentation covers ' || m || ' modules with ' || format('{:,}', c) || ' classes.' from tot
union all select 0, '05', ''
union all select 0, '06', '## Modules'
union all select 0, '07', ''
union all select 1, module_name, '- [' || module_name || '](' || module_name || '/index.md) (' || n || ' classes)' from ok)
select 'index.md' as path, * from lines""")
def job6(spark, sf):
    return PG.main_index_lines(_results(spark, sf))


# --------------------------------------------------------------------------
# Stubs
# --------------------------------------------------------------------------

_RECORD_DOCS = """
docs as (select module_name, class_name, arg_max(class_doc, seq) as class_doc
  from v_records group by module_name, class_name),"""


def _stub_ctes(stubs: str, docs: str) -> str:
    """Stubs of a view annotated from ``docs (module_name, class_name, class_doc)``."""
    return docs + f"""
sl as (select module_name, cast(i as bigint) as pos, arr[i + 1] as line
  from (select module_name, arr, unnest(range(len(arr))) as i
        from (select module_name, string_split(coalesce(content, ''), {NL}) as arr from {stubs}))),
sl2 as (select *, min(case when {O.strip('line')} <> '' then pos end) over
          (partition by module_name order by pos rows between 1 following and unbounded following) as next_pos,
        max(pos) over (partition by module_name) as last_pos,
        nullif(regexp_extract(line, 'class (\\w+)\\b[^:]*:\\s*$', 1), '') as decl
  from sl),
decls as (
  select d.module_name, d.decl as class_name, d.pos as decl_pos, coalesce(d.next_pos, d.last_pos) as insert_pos,
    coalesce(starts_with({O.lstrip('n.line')}, '\"\"\"') or starts_with({O.lstrip('n.line')}, ''''''''), false) as has_docstring
  from (select *, row_number() over (partition by module_name, decl order by pos) as rn
        from sl2 where decl is not null and pos < last_pos) d
  left join sl n on n.module_name = d.module_name and n.pos = d.next_pos
  where d.rn = 1),
ins as (
  select d.module_name, d.insert_pos as pos, 0 as sub, '    \"\"\"' || o.class_doc || '\"\"\"' as line
  from decls d join docs o on o.module_name = d.module_name and o.class_name = d.class_name
  where not d.has_docstring and o.class_doc is not null and o.class_doc <> ''),
annotated as (
  select module_name, module_name || '.pyi' as path, string_agg(line, {NL} order by pos, sub) as content,
    cast(count(*) filter (where sub = 0) as bigint) as inserted
  from (select module_name, pos, 1 as sub, line from sl union all select * from ins) u
  group by module_name)
"""


_STUB_SQL = duck_with("v_stubs", "v_records") + "," + _stub_ctes("v_stubs", _RECORD_DOCS)


@query("jn6_class_declarations", _STUB_SQL + """
select module_name, class_name, decl_pos, insert_pos, has_docstring from decls""")
def jn6(spark, sf):
    lines = SB.stub_lines(V(spark, sf, "v_stubs").repartition("module_name"))
    return SB.declarations(lines).drop(SB.FILE_ID)


# stubs of modules with records and, the same text, of modules without
_STUBS_AND_OTHERS = duck_with("v_stubs", "v_records") + """,
all_stubs as (select * from v_stubs union all select 'other' || module_name, content from v_stubs),""" + _stub_ctes("all_stubs", _RECORD_DOCS)


def _stubs_and_others(spark, sf):
    stubs = V(spark, sf, "v_stubs")
    return stubs.unionByName(stubs.withColumn("module_name", F.concat(F.lit("other"), "module_name")))


@query("jn5_stub_docs_join", _STUBS_AND_OTHERS + """
select a.module_name, a.inserted, a.content = s.content as unchanged from annotated a join all_stubs s using (module_name)""")
def jn5(spark, sf):
    # stubs of modules without records pass unchanged
    stubs = _stubs_and_others(spark, sf)
    out = SB.annotate_stubs(stubs, V(spark, sf, "v_records"), order_col="seq").alias("a").join(stubs.alias("s"), "module_name")
    return out.select("module_name", "inserted", (F.col("a.content") == F.col("s.content")).alias("unchanged"))


# stub files of which some are no UTF-8: with a byte more, in modules whose name has an even length
_BROKEN = "length(module_name) % 2 = 0"
_STUB_FILES_SQL = _STUBS_AND_OTHERS + f""",
files as (select module_name, path, inserted, content, {_BROKEN} as broken, not starts_with(module_name, 'other') as known,
  (select s.content from all_stubs s where s.module_name = annotated.module_name) as original from annotated)"""


def _stub_file_folder(spark, sf):
    """Folders of the stub files and of the annotated files made from them."""
    text = F.col("content").cast("binary")
    rows = _stubs_and_others(spark, sf).select(
        F.concat("module_name", F.lit(".pyi")).alias("path"),
        F.when(F.expr(_BROKEN), F.concat(text, F.lit(b"# \xff\n"))).otherwise(text).alias("data"))
    given, made = _scratch(spark, "stub-files"), _scratch(spark, "stubs")
    FS.write_files(rows, given)
    annotated = SB.annotate_stub_lines(IO.read_stub_lines(spark, given), V(spark, sf, "v_records"), order_col="seq")
    SB.write_stub_lines(annotated, f"{made}-lines")
    annotated = spark.read.parquet(f"{made}-lines")
    IO.write_stub_files(annotated, made)
    return annotated, made


@query("job3_stub_files", _STUB_FILES_SQL + """
select path, case when broken and known then 'not UTF-8' end as error,
  case when not broken then md5(encode(content)) when not known then md5(encode(original) || '# \\xFF\\x0A'::blob) end as digest from files""")
def job3_files(spark, sf):
    """Stub files read by lines, annotated and written as files: the bytes of
    each, or why it failed."""
    _, made = _stub_file_folder(spark, sf)
    files = FS.read_files(spark, made, "*.pyi").select("path", F.md5("data").alias("digest"))
    return FS.file_outcomes(spark, made).join(files, "path", "left").select("path", "error", "digest")


@query("job3_annotate_stubs", _STUB_SQL + "select module_name, path, content, inserted from annotated")
def job3(spark, sf):
    return SB.annotate_stubs(V(spark, sf, "v_stubs"), V(spark, sf, "v_records"), order_col="seq")


@query("agg9_stub_summary", _STUB_FILES_SQL + """
select cast(count(*) filter (where not (broken and known)) as bigint) as files_written, cast(count(*) as bigint) as files_total,
  cast(count(*) filter (where inserted > 0 and not broken) as bigint) as files_annotated,
  cast(sum(inserted) filter (where not broken) as bigint) as docstrings_inserted from files""")
def agg9(spark, sf):
    annotated, made = _stub_file_folder(spark, sf)
    return SB.stub_summary(SB.write_outcomes(SB.stub_files(annotated), FS.file_outcomes(spark, made)))


# --------------------------------------------------------------------------
# Exploration: search, export, inventory, modules
# --------------------------------------------------------------------------

@query("job7_search", duck_with("v_records") + """,
hits as (select * from v_records where contains(lower(synopsis), 'en'))
select seq, class_name, module_name, synopsis, (select count(*) from hits) as total_hits
from hits order by seq limit 10""")
def job7(spark, sf):
    return CT.search(V(spark, sf, "v_records"), "en", field="synopsis", limit=10, order_col="seq")


@query("ord3_search_page", duck_with("v_records") + """,
hits as (select * from v_records where contains(lower(class_name), 'vtkdoc1'))
select seq, class_name, module_name, synopsis, (select count(*) from hits) as total_hits
from hits order by seq limit 25""")
def ord3(spark, sf):
    # default search field (class name), a longer page
    return CT.search(V(spark, sf, "v_records"), "VTKDOC1", limit=25, order_col="seq")


@query("job9_export_label_cache", duck_with("v_records") + """
select class_name, seq, synopsis, action_phrase, coalesce(visibility_score, 0.3) as visibility_score
from v_records where synopsis <> '' or action_phrase <> ''""")
def job9(spark, sf):
    return CT.export_label_cache(V(spark, sf, "v_records"), keep=("seq",))


@query("agg1_classes_per_module", duck_with("v_inventory") + """
select module_name, cast(count(*) as bigint) as classes from v_inventory
where starts_with(class_name, 'vtk') and not starts_with(class_name, 'vtk_') and not starts_with(class_name, 'vtkm')
  and is_class and starts_with(module_name, 'vtk') group by module_name""")
def agg1(spark, sf):
    return CT.classes_per_module(V(spark, sf, "v_inventory"))


@query("agg1_discovery_totals", duck_with("v_inventory") + """
select cast(count(distinct module_name) as bigint) as modules, cast(count(*) as bigint) as classes from v_inventory
where starts_with(class_name, 'vtk') and not starts_with(class_name, 'vtk_') and not starts_with(class_name, 'vtkm')
  and is_class and starts_with(module_name, 'vtk')""")
def agg1_totals(spark, sf):
    return CT.discovery_totals(V(spark, sf, "v_inventory"))


@query("set2_distinct_modules", duck_with("v_records") + "select distinct module_name from v_records")
def set2(spark, sf):
    return CT.distinct_modules(V(spark, sf, "v_records"))


@query("agg5_database_size", duck_with("v_cache") + """
select sum(strlen(class_name) + 1 + strlen(synopsis) + 1) / 1048576.0 as size_mib from v_cache""")
def agg5(spark, sf):
    # a database of text lines, whose size SQL can tell
    path = _scratch(spark, "lines")
    V(spark, sf, "v_cache").select(F.concat_ws("\t", "class_name", "synopsis")).write.text(path)
    return CT.database_size_mib(spark, path).select("size_mib")


@query("ord4_page_method_order", _PAGES_SQL + """
select c.module_name, c.class_name, coalesce(h.headings, '') as headings from catalog c left join (
  select module_name, class_name, string_agg(headings, ' ' order by sec_ord) as headings from (
    select module_name, class_name, sec_ord, '### ' || {sec} || ' ' || string_agg('#### `' || method || '`', ' ' order by method) as headings
    from key_methods group by module_name, class_name, section, sec_ord) group by module_name, class_name) h
  on h.module_name = c.module_name and h.class_name = c.class_name""".format(sec=O.strip("replace(section, '|', '')")))
def ord4(spark, sf):
    # the headings of the "Methods" part in page order: sections as they stand, methods by name.
    # (Index orderings are the sort keys of the index line rows, see job5/job6.)
    part = PG.method_section_lines(F.col("structured_docs.sections"), F.col("semantic_methods"))
    headings = F.filter(part, lambda x: x.startswith("### ") | x.startswith("#### `"))
    return _catalog(spark, sf).select("module_name", "class_name", F.array_join(headings, " ").alias("headings"))


@query("src4_help_dump_profile", "with " + _views("v_help") + f""",
lines as (select module_name, class_name, unnest(string_split(help_text, {NL})) as line from v_help)
select module_name, class_name, cast(count(*) as bigint) as n_lines,
  cast(sum(length(line)) as bigint) as n_chars,
  cast(count(*) filter (where starts_with(line, ' |  ')) as bigint) as n_body_lines
from lines group by module_name, class_name""")
def src4(spark, sf):
    # the ingest profile of a help dump: lines, characters, bar-prefixed lines per text
    lines = hp.explode_lines(V(spark, sf, "v_help"))
    return lines.groupBy(*hp._KEYS).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("line")).cast("bigint").alias("n_chars"),
        F.count_if(F.col("line").startswith(" |  ")).alias("n_body_lines"),
    ).drop(hp.DOC_ID)


@query("src5_stub_declarations", _STUB_SQL + """,
n_decls as (select module_name, count(*) as n, count(*) filter (where has_docstring) as n_doc from decls group by module_name),
given as (select module_name, case when length(module_name) % 2 = 0 then content else content || chr(10) end as content from v_stubs)
select module_name, md5(content) as whole, md5(content) as by_lines, cast(coalesce(n, 0) as bigint) as n_declarations,
  cast(coalesce(n_doc, 0) as bigint) as n_with_docstring from given left join n_decls using (module_name)""")
def src5(spark, sf):
    # stub files, some without a newline at their end, read whole and by lines
    path = _scratch(spark, "stub-files")
    text = F.when(F.length("module_name") % 2 == 0, F.col("content")).otherwise(F.concat("content", F.lit("\n")))
    FS.write_files(V(spark, sf, "v_stubs").select(F.concat("module_name", F.lit(".pyi")).alias("path"), text.alias("data")), path)
    whole = IO.read_stubs(spark, path)
    lines = SB.annotate_stub_lines(IO.read_stub_lines(spark, path), V(spark, sf, "v_records").filter("false"))
    by_lines = lines.withColumn("text", F.concat("line", F.when(F.col("nl"), F.lit("\n")).otherwise(F.lit("")))).groupBy("module_name").agg(
        F.md5(F.expr("listagg(text) within group (order by block, row, sub)")).alias("by_lines"))
    decls = SB.declarations(SB.stub_lines(whole)).groupBy("module_name").agg(
        F.count(F.lit(1)).alias("n_declarations"), F.count_if("has_docstring").alias("n_with_docstring"))
    return whole.select("module_name", F.md5("content").alias("whole")).join(by_lines, "module_name", "left").join(decls, "module_name", "left").select(
        "module_name", "whole", "by_lines", F.coalesce("n_declarations", F.lit(0)).alias("n_declarations"), F.coalesce("n_with_docstring", F.lit(0)).alias("n_with_docstring"))


@query("src2_missing_sources", duck_with("v_records", "v_stubs") + """
select 'records' as source, 'written' as folder, count(*) as n_rows, false as failed from v_records
union all select 'records', 'missing', 0, false
union all select 'records, required', 'missing', 0, true
union all select 'stubs', 'written', count(*), false from v_stubs
union all select 'stubs', 'missing', 0, false""")
def src2(spark, sf):
    """Pages and stubs take a missing source as empty; statistics and search fail."""
    path = _scratch(spark, "sources")
    recs = V(spark, sf, "v_records")
    recs.select("module_name", "class_name", "class_doc", "synopsis").write.json(f"{path}/records")
    FS.write_files(V(spark, sf, "v_stubs").select(F.concat("module_name", F.lit(".pyi")).alias("path"), F.col("content").alias("data")), f"{path}/stubs")

    def row(source, folder, df):
        failed = df is None
        n = spark.range(1).select(F.lit(0).cast("bigint").alias("n_rows")) if failed else df.agg(F.count(F.lit(1)).alias("n_rows"))
        return n.select(F.lit(source).alias("source"), F.lit(folder).alias("folder"), "n_rows", F.lit(failed).alias("failed"))

    try:
        required = IO.read_records(spark, f"{path}/none")
    except AnalysisException:
        required = None
    rows = [row("records", "written", IO.read_records(spark, f"{path}/records")), row("records", "missing", IO.read_records(spark, f"{path}/none", missing_ok=True)),
            row("records, required", "missing", required),
            row("stubs", "written", IO.read_stubs(spark, f"{path}/stubs")), row("stubs", "missing", IO.read_stubs(spark, f"{path}/none"))]
    return reduce(DataFrame.unionByName, rows)


@query("snk4_page_files", _PAGES_SQL + _PAGE_FILES_CTES + "select path, content from page_files")
def snk4(spark, sf):
    """Pages and indexes written as files and read back."""
    from docsmith.session import materialize

    recs = materialize(_catalog(spark, sf), "catalog")
    path = _scratch(spark, "pages")
    IO.write_page_files(PG.module_pages(recs), PG.module_index_lines(recs), PG.main_index_lines(PG.module_results(recs)), path)
    return FS.read_files(spark, path, "*.md").select("path", F.decode("data", "UTF-8").alias("content"))


def _stub_line_rows(stubs, lines_per_split: int = 7):
    """The line rows ``io.read_stub_lines`` gives for these texts, with each file
    cut into splits of ``lines_per_split`` lines (a line reader yields no
    empty last line after a final newline)."""
    split = F.split(F.coalesce(F.col("content"), F.lit("")), "\n", -1)
    # a file's facts stand below the explode: beside it they are worked out, from the whole text, for every line
    files = stubs.select("module_name", F.octet_length("content").cast("bigint").alias("file_size"), split.alias("lines"), F.size(split).alias("n"))
    pieces = files.select("module_name", F.col("module_name").alias("file"), "file_size", F.posexplode("lines").alias("pos", "line"), "n")
    lines = pieces.filter(~((F.col("pos") == F.col("n") - 1) & (F.col("line") == "")))
    return lines.select(
        "module_name", "file", F.floor(F.col("pos") / lines_per_split).cast("bigint").alias("block"),
        F.col("pos").cast("bigint").alias("row"), "line", "file_size")


@query("job3_annotate_stub_lines", _STUB_SQL + """,
meta as (select module_name, max(pos) as last_pos, arg_max(line, pos) = '' as tail_nl from sl group by module_name),
m2 as (select module_name, last_pos, tail_nl, case when tail_nl then last_pos - 1 else last_pos end as last_h from meta),
originals as (
  select s.module_name, cast(s.pos // 7 as bigint) as block, s.pos as row, 1 as sub, s.line,
    (s.pos < m.last_h or m.tail_nl) as nl
  from sl s join m2 m on m.module_name = s.module_name
  where not (m.tail_nl and s.pos = m.last_pos)),
ins_rows as (
  select d.module_name,
    case when n.pos is null and m.tail_nl then m.last_h else d.insert_pos end as target,
    case when n.pos is null and m.tail_nl then 2 else 0 end as sub,
    '    \"\"\"' || o.class_doc || '\"\"\"' as line
  from decls d join docs o on o.module_name = d.module_name and o.class_name = d.class_name
  join m2 m on m.module_name = d.module_name
  left join (select module_name, pos from sl where """ + O.strip("line") + """ <> '') n
    on n.module_name = d.module_name and n.pos = d.insert_pos
  where not d.has_docstring and o.class_doc is not null and o.class_doc <> '')
select module_name, block, row, sub, line, nl from originals
union all
select module_name, cast(target // 7 as bigint), target, sub, line, true from ins_rows""")
def job3_lines(spark, sf):
    # the line-level stub path (for stub files too large for one task), on the
    # whole V-stubs view cut into 7-line splits
    recs = LL.latest_per_key(V(spark, sf, "v_records").select("module_name", "class_name", "class_doc", "seq"),
                             ["module_name", "class_name"], "seq")
    out = SB.annotate_stub_lines(_stub_line_rows(V(spark, sf, "v_stubs")), recs)
    return out.select("module_name", "block", "row", "sub", "line", "nl")


@query("job10_build_all", _CATALOG_SQL + """
select module_name, class_name, class_doc, role, input_datatype, output_datatype, semantic_methods,
  synopsis, action_phrase, visibility_score, n_sections, n_methods from catalog""")
def job10(spark, sf):
    # the staged build end to end: every stage is written under the session's
    # checkpoint folder, and the records are read back from the JSON sink
    import uuid

    from docsmith.plans.jobs import build_all
    from docsmith.session import ensure_checkpoint_dir
    from docsmith.sources import io as IO

    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/job10-{uuid.uuid4().hex}"
    res = build_all(spark, V(spark, sf, "v_help"), V(spark, sf, "v_classes"), V(spark, sf, "v_bases"),
                    HY.ports_from_text(V(spark, sf, "v_ports")), V(spark, sf, "v_help_methods"), out,
                    stubs=V(spark, sf, "v_stubs"),
                    label_cache=LL.dedupe_label_cache(V(spark, sf, "v_cache"), "seq"))
    assert res.ok, res.failed_stage
    recs = IO.read_records(spark, f"{out}/records")
    secs = F.col("structured_docs.sections")
    return recs.select(
        "module_name", "class_name", "class_doc", "role", "input_datatype", "output_datatype",
        F.array_join("semantic_methods", ",").alias("semantic_methods"),
        "synopsis", "action_phrase", "visibility_score",
        F.size(F.map_keys(secs)).cast("bigint").alias("n_sections"),
        CT.record_method_count().alias("n_methods"),
    )


# Some classes are given again with another text, and some of these once more
# with the first one, in folders that are read in this order.
_LAST_SQL = _catalog_sql("v_help_last", "," + _views("v_help_again", "v_help_stubs") + """,
v_help_last as (
  select * from v_help where not exists (select 1 from v_help_again a where a.class_name = v_help.class_name and a.conv_id % 8 = 4)
  union all select module_name, class_name, help_text from v_help_again where conv_id % 8 = 4)""") + _PAGES_CTES + _PAGE_FILES_CTES + "," + _stub_ctes(
    "v_help_stubs", """
docs as (select module_name, class_name, class_doc from catalog),""") + """
select 'page' as kind, path, content from page_files
union all select 'stub', path, content from annotated
union all select 'record', module_name || '/' || class_name, class_doc from catalog"""


@query("job10_last_wins", _LAST_SQL)
def job10_last(spark, sf):
    """The build on a dump that gives classes again: the last text of a class is
    in the pages, the indexes, the stubs, and last in the records' file."""
    from docsmith.plans.jobs import build_all

    again, first = V(spark, sf, "v_help_again"), V(spark, sf, "v_help")
    dump, out = _scratch(spark, "dump"), _scratch(spark, "job10")
    first.write.parquet(f"{dump}/1")
    again.drop("conv_id").write.parquet(f"{dump}/2")
    first.join(again.filter("conv_id % 8 = 0"), "class_name", "left_semi").write.parquet(f"{dump}/3")
    res = build_all(spark, IO.read_help_dump(spark, f"{dump}/*", with_seq=True), V(spark, sf, "v_classes"), V(spark, sf, "v_bases"),
                    HY.ports_from_text(V(spark, sf, "v_ports")), V(spark, sf, "v_help_methods"), out, stubs=V(spark, sf, "v_help_stubs"),
                    label_cache=LL.dedupe_label_cache(V(spark, sf, "v_cache"), "seq"))
    assert res.ok, res.failed_stage
    files = lambda kind, at, glob: FS.read_files(spark, at, glob).select(F.lit(kind).alias("kind"), "path", F.decode("data", "UTF-8").alias("content"))
    recs = IO.read_records(spark, f"{out}/records", with_seq=True)
    last = LL.latest_per_key(recs.select("module_name", "class_name", "class_doc", "seq"), ["module_name", "class_name"], "seq")
    return files("page", f"{out}/markdown", "*.md").unionByName(files("stub", f"{out}/stubs", "*.pyi")).unionByName(
        last.select(F.lit("record").alias("kind"), F.concat_ws("/", "module_name", "class_name").alias("path"), F.col("class_doc").alias("content")))
