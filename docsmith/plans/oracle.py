"""DuckDB SQL fragments for the correctness oracle.

The oracle re-states each operator in plain SQL over the same views so that
the driver can compare Spark's result with an independent engine.  Helpers
here mirror the column functions of ``docsmith.functions``.
"""

from __future__ import annotations

from docsmith.schema import PY_WHITESPACE_CLASS as WS
from docsmith.schema import SECTION_HEADERS

NL = "chr(10)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def lstrip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{WS}+', '', 'g')"


def cpp(x: str) -> str:
    return (f"(contains({x}, 'C++:') or starts_with({strip(x)}, 'virtual ') "
            f"or (contains({x}, '::') and contains(lower({x}), 'vtk')))")


def page_noise(x: str) -> str:
    s = strip(x)
    return (f"({s} = '' or starts_with({s}, 'C++:') or contains({x}, '::') "
            f"or starts_with({s}, '---'))")


def finish(x: str) -> str:
    return f"regexp_replace({strip(f'coalesce({x}, {chr(39)}{chr(39)})')}, '\\n{{3,}}', {NL}||{NL}, 'g')"


def clean_doc(x: str) -> str:
    """TXT8 on a whole string."""
    return finish(
        f"array_to_string(list_transform(list_filter(string_split(coalesce({x}, ''), {NL}), "
        f"lambda l: not {cpp('l')}), lambda l: {strip('l')}), {NL})"
    )


def is_header(x: str) -> str:
    return "(" + " or ".join(f"contains({x}, '{h}')" for h in SECTION_HEADERS) + ")"


def parse_ctes(src: str) -> str:
    """CTEs ``lines, m2, m4, blocks, resolved, cdocs`` parsing relation
    ``src(module_name, class_name, help_text)``; to follow a WITH list."""
    w = ("window w as (partition by module_name, class_name order by pos "
         "rows between unbounded preceding and current row)")
    is_cls = f"coalesce(starts_with({strip('line')}, 'class ' || class_name), false)"
    return f"""
lines as (
  select module_name, class_name, cast(i as bigint) as pos, arr[i + 1] as line
  from (select module_name, class_name, arr, unnest(range(len(arr))) as i
        from (select module_name, class_name, string_split(coalesce(help_text, ''), {NL}) as arr from {src}))),
m1 as (
  select *, starts_with(line, ' |  ') as is_p, {is_cls} as is_cls,
    contains(line, 'Method resolution order:') and not {is_cls} as is_mro,
    {is_header('line')} as is_hdr
  from lines),
m2 as (
  select *, max(is_cls::int) over w as cls_seen, max(is_mro::int) over w as mro_seen,
    sum(is_hdr::int) over w as sec,
    last_value(case when is_hdr then replace({strip('line')}, ' |  ', '') end ignore nulls) over w as sec_name
  from m1 {w}),
m3 as (
  select *, (not is_hdr and is_p and sec > 0) as is_content, replace(line, ' |  ', '') as mline
  from m2),
m3b as (
  select *, (is_content and {strip('line')} <> '' and contains(line, '(')
             and not starts_with(line, ' |      ') and not starts_with({strip('line')}, '------')) as is_sig
  from m3),
m4 as (
  select *, sum(is_sig::int) over w as mid,
    max(case when is_sig then sec end) over w as sig_sec,
    last_value(case when is_sig then {strip("split_part(mline, '(', 1)")} end ignore nulls) over w as mname
  from m3b {w}),
blocks as (
  select module_name, class_name, sec, mid, any_value(mname) as method, any_value(sec_name) as section,
    min(pos) as start,
    {finish(f"string_agg(case when not {cpp('mline')} then {strip('mline')} end, {NL} order by pos)")} as doc
  from m4
  where is_content and mid > 0 and sig_sec = sec and mname <> ''
  group by module_name, class_name, sec, mid),
nb as (select * from blocks where doc <> ''),
r1 as (
  select *, max(sec) over (partition by module_name, class_name, section) as last_sec,
    min(sec) over (partition by module_name, class_name, section) as sec_ord
  from nb),
r2 as (
  select *, max(mid) over (partition by module_name, class_name, sec, method) as last_mid,
    min(start) over (partition by module_name, class_name, sec, method) as ord
  from r1 where sec = last_sec),
resolved as (
  select module_name, class_name, section, method, ord, doc, sec_ord, sec, mid from r2 where mid = last_mid),
cdocs as (
  select module_name, class_name,
    {finish(f"string_agg(case when is_p and not is_cls and cls_seen = 1 and mro_seen = 0 and not {cpp('substring(line, 5)')} then {strip('substring(line, 5)')} end, {NL} order by pos)")} as class_doc
  from m2 group by module_name, class_name)
"""


def role_case() -> str:
    """CASE over the role rules; expects the columns of ``facts_ctes``."""
    from docsmith.operators.hierarchy import ALGORITHM, ROLE_RULES

    def isa_any(names):
        return "(" + " or ".join(f"coalesce(isa_{n}, false)" for n in names) + ")"

    def names_in(names):
        return "class_name in (" + ", ".join(f"'{n}'" for n in names) + ")"

    algo = isa_any([ALGORITHM])
    arms = []
    for (kind, *args), role in ROLE_RULES:
        if kind == "name_in":
            cond = names_in(args[0])
        elif kind == "unknown":
            cond = "not known"
        elif kind == "not_instantiable":
            cond = "not coalesce(instantiable, false)" + (f" and {names_in(args[0])}" if args[0] else "")
        elif kind == "no_isa":
            cond = "not coalesce(has_isa, false)"
        elif kind == "algo_name_in":
            cond = f"{algo} and {names_in(args[0])}"
        elif kind == "algo_isa_any":
            cond = f"{algo} and {isa_any(args[0])}"
        elif kind == "isa_any":
            cond = isa_any(args[0])
        elif kind == "name_contains":
            cond = "(" + " or ".join(f"contains(class_name, '{p}')" for p in args[0]) + ")"
        elif kind == "name_starts":
            cond = f"starts_with(class_name, '{args[0]}')"
        elif kind == "algo_ports":
            arms.append(f"when {algo} then case when coalesce(n_in,0) = 0 and coalesce(n_out,0) > 0 then 'input' "
                        "when coalesce(n_in,0) > 0 and coalesce(n_out,0) > 0 then 'filter' "
                        "when coalesce(n_in,0) > 0 and coalesce(n_out,0) = 0 then 'output' else 'filter' end")
            continue
        else:
            cond = "true"
        arms.append(f"when {cond} then '{role}'")
    return "case " + " ".join(arms) + " end"


def facts_ctes(names_sql: str) -> str:
    """CTEs ``isa, flags, facts`` for the class names selected by
    ``names_sql`` (one column ``class_name``); needs ``with recursive`` and
    views ``v_classes, v_bases``."""
    from docsmith.operators.hierarchy import rule_ancestors
    flags = ", ".join(f"bool_or(ancestor = '{n}') as isa_{n}" for n in rule_ancestors())
    return f"""
isa(class_name, ancestor) as (
  select class_name, class_name from v_classes
  union
  select i.class_name, b.base_name from isa i join v_bases b on b.class_name = i.ancestor),
flags as (select class_name, {flags} from isa group by class_name),
names as ({names_sql}),
facts as (
  select n.class_name, c.instantiable, c.has_isa, c.n_in, c.n_out, c.class_name is not null as known, f.* exclude (class_name)
  from (select distinct class_name from names) n
  left join v_classes c on c.class_name = n.class_name
  left join flags f on f.class_name = n.class_name)
"""


def norm_types(x: str) -> str:
    return f"coalesce(array_to_string(list_filter(string_split({x}, {NL}), lambda t: t is not null and t <> ''), ','), '')"


def datatypes_sql() -> tuple[str, str]:
    gate = "(known and coalesce(instantiable, false) and coalesce(has_isa, false) and coalesce(isa_vtkAlgorithm, false))"
    inp = f"case when {gate} and n_in > 0 then coalesce(p.in_types, '') else '' end"
    out = f"case when {gate} and n_out > 0 then coalesce(p.out_types, '') else '' end"
    return inp, out


def port0_cte() -> str:
    return f"""
port0 as (
  select class_name,
    max(case when direction = 'in' then {norm_types('types')} end) as in_types,
    max(case when direction = 'out' then {norm_types('types')} end) as out_types
  from v_ports where port = 0 group by class_name)
"""


def boilerplate_sql(x: str) -> str:
    from docsmith.schema import BOILERPLATE_METHODS
    return f"(starts_with({x}, '_') or {x} in (" + ", ".join(f"'{m}'" for m in BOILERPLATE_METHODS) + "))"


def semantic_cte(src: str) -> str:
    return f"""
sem as (
  select class_name, string_agg(method_name, ',' order by method_name) as semantic, count(*) as n_sem
  from (select distinct class_name, method_name from {src}
        where is_callable and not {boilerplate_sql('method_name')})
  group by class_name)
"""


def sql_lit(text: str) -> str:
    """A DuckDB string literal for ``text``."""
    return "'" + text.replace("'", "''") + "'"
