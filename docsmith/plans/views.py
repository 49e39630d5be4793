"""Test views: catalog-shaped inputs derived from the driver's tables.

Each view is one SQL text with three macros, expanded per engine so Spark and
DuckDB read the same rows:

* ``{NL}`` newline literal,
* ``{AGG(x, o)}`` ordered string aggregation joined by newlines,
* ``{T:name}`` a driver table (a parquet file for Spark, a view for DuckDB),
* ``{Q}`` a single quote inside a string literal.

The views read whole tables; their size grows with the scale factor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEW_SQL: dict[str, str] = {
    "v_help": """
with b as (select conv_id, turn, role,
   concat(' |  Turn', turn, '(self, arg) -> str', {NL}, ' |      ', replace(text, {NL}, concat({NL},' |      ')),
     case when turn % 2 = 0 then concat({NL},' |      C++: virtual void Turn', turn, '() override;') else '' end, {NL}, ' |  ') as blk from {T:conversations}),
r as (select conv_id, role, {AGG(blk, turn)} as body from b group by conv_id, role),
sct as (select conv_id, case role when 'user' then 1 when 'assistant' then 2 else 3 end as o,
   concat(case role when 'user' then ' |  Methods defined here:' when 'assistant' then ' |  Methods inherited from vtkBase:' else ' |  Static methods defined here:' end, {NL}, ' |  ', {NL}, body) as sec from r),
h as (select conv_id, {AGG(sec, o)} as secs from sct group by conv_id)
select concat('vtkMod', h.conv_id % 7) as module_name, concat('vtkConv', h.conv_id) as class_name,
  concat('Help on class vtkConv', h.conv_id, ':', {NL}, {NL}, 'class vtkConv', h.conv_id, '(vtkBase)', {NL}, ' |  ',
   replace(c.text, {NL}, concat({NL},' |  ')), {NL}, ' |  Method resolution order:', {NL}, ' |      vtkConv', h.conv_id, {NL}, ' |      vtkBase', {NL}, ' |  ', {NL}, h.secs) as help_text
from h join {T:conversations} c on c.conv_id = h.conv_id and c.turn = 0
""",
    "v_records": """
select concat('vtk', source) as module_name, concat('vtkDoc', doc_id) as class_name, doc_id as seq,
  concat(text, case doc_id % 4 when 0 then concat({NL}, 'C++: void f()') when 1 then concat({NL}, ' virtual void f()') when 2 then concat({NL}, 'see vtkFoo::Bar', {NL}, {NL}, {NL}, {NL}, 'std::x') else '' end) as class_doc,
  case when doc_id % 5 = 0 then '' else concat('Doc ', doc_id, ' in ', lang, '.') end as synopsis,
  case when doc_id % 10 < 3 then '' else concat(lang, ' prose') end as action_phrase,
  cast(doc_id % 101 as double) / 100 as visibility_score
from {T:documents}
union all
select concat('vtk', source), concat('vtkDoc', doc_id), doc_id + 100000000, concat('second ', lang), 'Later.', '', cast(0.35 as double)
from {T:documents} where doc_id % 20 = 0
""",
    "v_inventory": """
select concat(case when p_size % 6 = 0 then 'util' else 'vtk' end, replace(p_brand, '#', '')) as module_name,
  concat(case p_partkey % 5 when 0 then 'vtk_h' when 1 then 'vtkmX' when 2 then 'other' else 'vtkPart' end, p_partkey) as class_name,
  p_partkey % 11 <> 0 as is_class
from {T:part}
""",
    "v_cache": """
select concat('vtkDoc', doc_id) as class_name, doc_id as seq, concat('Quality ', quality, '.') as synopsis,
  concat('toxic ', toxic) as action_phrase, cast(doc_id % 101 as double) / 100 as visibility_score from {T:labels}
union all
select concat('vtkDoc', doc_id), doc_id + 100000000, 'Relabelled.', 'relabelling', cast(0.85 as double) from {T:labels} where doc_id % 25 = 0
union all
select distinct concat(case conv_id % 2 when 0 then 'vtkConv' else 'vtkOtherConv' end, conv_id), conv_id, concat('Turns of ', conv_id, '.'), 'conversing', cast(0.65 as double) from {T:conversations}
""",
    "v_resp": """
select concat('vtkDoc', doc_id) as class_name,
  case doc_id % 9
   when 0 then concat('```json', {NL}, '{"synopsis": "Doc ', doc_id, '", "action_phrase": "reading", "visibility_score": 0.9}', {NL}, '```')
   when 1 then concat('{"synopsis": " {Q}Doc ', doc_id, '.{Q} ", "action_phrase": "reading", "visibility_score": 0.25}')
   when 2 then 'Sorry, no JSON.'
   when 3 then '[1, 2]'
   when 4 then concat('{"synopsis": "Doc ', doc_id, '", "visibility_score": "high"}')
   when 5 then concat('{"synopsis": "Doc ', doc_id, '", "visibility_score": true}')
   when 6 then concat('{"synopsis": "Doc ', doc_id, '", "visibility_score": 1.7}')
   when 7 then concat('{"synopsis": "Doc ', doc_id, '", "visibility": 0, "visibility_score": 0.4}')
   else '{"synopsis": 5, "visibility": 0.6}' end as content
from {T:documents}
""",
    "v_methods": """
select distinct concat('vtkUser', user_id) as class_name,
  case event_type when 'error' then 'DebugOn' when 'signup' then 'Modified' when 'view' then '__repr__'
   when 'click' then concat('Set', regexp_extract(props, '[0-9]+', 0)) else concat('_p', regexp_extract(props, '[0-9]+', 0)) end as method_name,
  value >= 1 as is_callable
from {T:events}
union all
select distinct concat('vtkDoc', doc_id), concat('Get', lang), true from {T:documents}
""",
    "v_classes": """
select concat('vtkPart', p_partkey) as class_name, p_partkey % 13 <> 0 as instantiable, p_partkey % 17 <> 0 as has_isa,
  p_size % 3 as n_in, cast(floor(p_size / 3.0) as bigint) % 3 as n_out from {T:part}
union all
select concat(case conv_id % 6 when 5 then 'vtkOtherConv' else 'vtkConv' end, conv_id), conv_id % 9 <> 0, conv_id % 8 <> 0, conv_id % 3, conv_id % 2
from (select distinct conv_id from {T:conversations}) c
union all
select concat(case doc_id % 3 when 0 then 'vtkDoc' else 'vtkOtherDoc' end, doc_id), doc_id % 9 <> 0, doc_id % 8 <> 0, doc_id % 4, doc_id % 5 from {T:documents}
""",
    "v_bases": """
select concat(case kind when 'part' then 'vtkPart' when 'conv' then 'vtkConv' else 'vtkDoc' end, p_partkey) as class_name,
  case when p_partkey < 14 or kind <> 'part' then element else concat('vtkPart', cast(floor(p_partkey / 4.0) as bigint)) end as base_name
from (select p_partkey, 'part' as kind from {T:part} union all select distinct conv_id, 'conv' from {T:conversations} union all select doc_id, 'doc' from {T:documents}) part join (values (0,'vtkAlgorithm'),(1,'vtkAbstractMapper'),(2,'vtkWriter'),(3,'vtkReader'),(4,'vtkImporter'),(5,'vtkRenderer'),(6,'vtkRenderWindow'),
  (7,'vtkContextItem'),(8,'vtkView'),(9,'vtkRenderPass'),(10,'vtkCamera'),(11,'vtkLight'),(12,'vtkProp'),(13,'vtkProperty')) v(k, element) on v.k = p_partkey % 14
union all
select x, y from (values ('vtkAbstractMapper','vtkAlgorithm'),('vtkWriter','vtkAlgorithm'),('vtkReader','vtkAlgorithm'),('vtkCamera','vtkObject'),('vtkAlgorithm','vtkObject')) w(x, y)
""",
    "v_ports": """
select class_name, direction, port, {AGG(dtype, dtype)} as types from (
  select concat('vtkPart', l_partkey) as class_name, case l_linestatus when 'O' then 'out' else 'in' end as direction, l_linenumber - 1 as port,
    case when cast(l_quantity as int) % 5 = 0 then '' else concat('vtkType', cast(l_quantity as int) % 5) end as dtype from {T:lineitem}
  union all
  select concat('vtkConv', conv_id), case turn % 2 when 0 then 'in' else 'out' end, cast(floor(turn / 2.0) as int), concat('vtkTurn', turn) from {T:conversations}
  union all
  select concat('vtkDoc', doc_id), case doc_id % 2 when 0 then 'in' else 'out' end, 0, concat('vtkText', lang) from {T:documents}) p
group by class_name, direction, port
""",
    "v_stubs": """
select concat('vtk', source) as module_name, {AGG(decl, doc_id)} as content from (
  select source, doc_id, concat('class ', case doc_id % 7 when 0 then 'vtkOther' else 'vtkDoc' end, doc_id, '(vtkBase):', {NL},
    case doc_id % 5 when 0 then concat('    \"\"\"present\"\"\"', {NL}) when 1 then {NL} else '' end, '    def F(self): ...', {NL}) as decl
  from {T:documents}) d
group by source
""",
    # Our addition: some classes of the help dump given again with another text.
    "v_help_again": """
select concat('vtkMod', conv_id % 7) as module_name, concat('vtkConv', conv_id) as class_name,
  concat('Help on class vtkConv', conv_id, ':', {NL}, {NL}, 'class vtkConv', conv_id, '(vtkBase)', {NL}, ' |  Given again: ', conv_id, {NL},
    ' |  Method resolution order:', {NL}, ' |      vtkConv', conv_id, {NL}, ' |  ', {NL}, ' |  Methods defined here:', {NL}, ' |  ', {NL},
    ' |  Turn0(self) -> str', {NL}, ' |      Given again.', {NL}) as help_text, conv_id
from (select distinct conv_id from {T:conversations} where conv_id % 4 = 0) c
""",
    # Our addition: stubs of the help-dump classes.
    "v_help_stubs": """
select concat('vtkMod', conv_id % 7) as module_name, {AGG(decl, conv_id)} as content from (
  select conv_id, concat('class vtkConv', conv_id, '(vtkBase):', {NL},
    case conv_id % 5 when 0 then concat('    \"\"\"present\"\"\"', {NL}) when 1 then {NL} else '' end, '    def F(self): ...', {NL}) as decl
  from (select distinct conv_id from {T:conversations}) c) d
group by conv_id % 7
""",
    # Our addition: catalog methods for the help-dump classes, so that page
    # rendering (key methods, method sections) has matching methods to show.
    "v_help_methods": """
select distinct concat('vtkConv', conv_id) as class_name, concat('Turn', turn) as method_name,
  turn % 3 <> 2 as is_callable
from {T:conversations}
union all
select distinct concat('vtkConv', conv_id), 'GetClassName', true from {T:conversations}
""",
}

_AGG_RE = re.compile(r"\{AGG\(([^,]+),\s*([^)]+)\)\}")
_TABLE_RE = re.compile(r"\{T:(\w+)\}")


def render(sql: str, engine: str, sf_dir: str | None = None) -> str:
    """Expand the view macros for ``engine`` ('spark' or 'duckdb')."""
    if engine == "spark":
        sql = _AGG_RE.sub(lambda m: f"listagg({m.group(1)}, '\\n') within group (order by {m.group(2)})", sql)
        sql = sql.replace("{NL}", "'\\n'").replace("{Q}", "\\'")
        sql = _TABLE_RE.sub(lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", sql)
    else:
        sql = _AGG_RE.sub(lambda m: f"string_agg({m.group(1)}, chr(10) order by {m.group(2)})", sql)
        sql = sql.replace("{NL}", "chr(10)").replace("{Q}", "''")
        sql = _TABLE_RE.sub(lambda m: m.group(1), sql)
    return sql


_staged: dict[tuple[str, str], str] = {}


def stage_view(spark: SparkSession, name: str, sf_dir: str, path: str) -> None:
    """Write a view; from then on :func:`spark_view` reads what was written.  For
    the benchmark, which times operators and not the views they read."""
    spark.sql(render(VIEW_SQL[name], "spark", sf_dir)).write.parquet(path)
    _staged[name, sf_dir] = path


def spark_view(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    if (name, sf_dir) in _staged:
        return spark.read.parquet(_staged[name, sf_dir])
    return spark.sql(render(VIEW_SQL[name], "spark", sf_dir))


def duck_with(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause defining the named views for DuckDB."""
    parts = [f"{n} as ({render(VIEW_SQL[n], 'duckdb')})" for n in names]
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n"
