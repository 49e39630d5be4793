"""Class classification (CLS1-CLS6) from catalog tables.

Inputs replace live introspection with data:

* ``classes(class_name, instantiable, has_isa, n_in, n_out)``
* ``class_bases(class_name, base_name)``: direct bases
* ``ports(class_name, direction, port, types array<string>)``
* ``class_methods(class_name, method_name, is_callable)``

Roles and data types need only the ancestors that a rule names: their bits are
carried down the base edges (:func:`isa_flags`), without the closure.  The IsA
closure itself (CLS1) is computed by semi-naive path doubling: each round joins
only the newly found pairs with the pairs known so far.  Rounds = log2 of the
depth of the inheritance graph (not its size); each round's result is written
as parquet under the
session's checkpoint directory (the cluster's shared folder) and read back, so
lineage stays short and a lost executor re-reads the last round instead of
recomputing all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsmith.operators.filters import is_boilerplate
from docsmith.session import materialize

# --------------------------------------------------------------------------
# The role rules, in order (first match wins).
#   ("name_in", names)         class name is one of names
#   ("unknown",)               class not in the catalog
#   ("not_instantiable", names | None)
#   ("no_isa",)
#   ("isa_any", ancestors)     class IsA any of ancestors
#   ("algo_isa_any", ancestors) IsA vtkAlgorithm and any of ancestors
#   ("algo_name_in", names)    IsA vtkAlgorithm and name is one of names
#   ("algo_ports",)            IsA vtkAlgorithm: role from port counts
#   ("name_contains", parts), ("name_starts", prefix)
#   ("always",)
# --------------------------------------------------------------------------
ALGORITHM = "vtkAlgorithm"
NON_INSTANTIABLE_FILTERS = (
    "vtkHyperTreeGridAlgorithm",
    "vtkImageAlgorithm",
    "vtkPartitionedDataSetAlgorithm",
    "vtkPartitionedDataSetCollectionAlgorithm",
    "vtkReaderAlgorithm",
    "vtkStatisticsAlgorithm",
    "vtkThreadedImageAlgorithm",
)
ROLE_RULES = (
    (("name_in", ("vtkNamedColors", "vtkColorSeries")), "color"),
    (("unknown",), "utility"),
    (("not_instantiable", NON_INSTANTIABLE_FILTERS), "filter"),
    (("not_instantiable", None), "utility"),
    (("no_isa",), "utility"),
    (("algo_name_in", ("vtkResliceCursorPolyDataAlgorithm", "vtkMultiTimeStepAlgorithm")), "filter"),
    (("algo_isa_any", ("vtkAbstractMapper", "vtkTexture")), "properties"),
    (("algo_isa_any", ("vtkWriter", "vtkExporter", "vtkImageWriter")), "output"),
    (("algo_isa_any", ("vtkReader",)), "input"),
    (("algo_ports",), None),
    (("isa_any", ("vtkImporter",)), "input"),
    (("isa_any", ("vtkRenderer",)), "renderer"),
    (("isa_any", ("vtkRenderWindow", "vtkRenderWindowInteractor")), "infrastructure"),
    (("isa_any", ("vtkInteractorStyle", "vtkAbstractPicker")), "infrastructure"),
    (("name_in", ("vtkImageViewer", "vtkImageViewer2", "vtkViewTheme")), "infrastructure"),
    (("isa_any", ("vtkContextActor", "vtkContextView", "vtkContextMapper2D", "vtkContextItem")), "infrastructure"),
    (("isa_any", ("vtkView",)), "infrastructure"),
    (("isa_any", ("vtkRenderPass",)), "renderer"),
    (("isa_any", ("vtkExporter",)), "output"),
    (("isa_any", ("vtkCamera", "vtkCameraActor")), "scene"),
    (("isa_any", ("vtkLight", "vtkLightKit", "vtkLightActor")), "scene"),
    (("isa_any", ("vtkAbstractWidget", "vtk3DWidget")), "scene"),
    (("isa_any", ("vtkProp",)), "properties"),
    (("isa_any", ("vtkProperty", "vtkVolumeProperty")), "properties"),
    (("isa_any", ("vtkTexture",)), "properties"),
    (("name_contains", ("LookupTable", "ColorTransfer")), "properties"),
    (("name_starts", "vtkOpenGL"), "renderer"),
    (("always",), "utility"),
)
DEFAULT_ROLE = "utility"


def rule_ancestors() -> list[str]:
    """Every ancestor name a rule tests, vtkAlgorithm first."""
    names = [ALGORITHM]
    for (kind, *args), _ in ROLE_RULES:
        if kind in ("isa_any", "algo_isa_any"):
            names += [a for a in args[0] if a not in names]
    return names


# --------------------------------------------------------------------------
# CLS1: IsA closure
# --------------------------------------------------------------------------

def isa_closure(classes: DataFrame, class_bases: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``isa(class_name, ancestor)``: every class of ``classes`` with itself
    and all its transitive bases.  Diamonds and cycles are handled (a pair is
    emitted once; iteration stops when a round finds no new pair).

    Semi-naive path doubling over the base edges: the first job writes every
    pair at distance 1 or 2, and after round k every pair joined by a path of
    length <= 2**(k+1) is known, so the number of rounds is about log2 of the
    hierarchy depth.  The shortest path of a pair first
    reachable in round k splits after exactly 2**(k-1) steps into a pair new
    in round k-1 and a known pair, so each round joins only the previous
    round's new pairs (``delta``) with the pairs found so far.  Pairs carry their shortest
    distance: when no pair of length 2**k exists after round k, no longer
    path exists either, and the loop stops without an extra empty round.
    Every round's new pairs are written once under the checkpoint directory;
    the pair set is the union of them.
    """
    edges = (
        class_bases.select("class_name", F.col("base_name").alias("ancestor"))
        .filter(F.col("class_name").isNotNull() & F.col("ancestor").isNotNull()
                & (F.col("class_name") != F.col("ancestor")))
        .distinct()
    )
    # the first part holds every pair at distance 1 or 2 (edges and their
    # compositions), written in one job
    two = (edges.alias("a").join(edges.alias("b"), F.col("a.ancestor") == F.col("b.class_name"))
           .select(F.col("a.class_name").alias("class_name"), F.col("b.ancestor").alias("ancestor"))
           .filter(F.col("class_name") != F.col("ancestor")))
    first = materialize(
        edges.withColumn("dist", F.lit(1)).unionByName(two.withColumn("dist", F.lit(2)))
        .groupBy("class_name", "ancestor").agg(F.min("dist").alias("dist")),
        "isa-edges",
    )
    parts = [first]
    delta = first.filter(F.col("dist") == 2)
    reach = 2  # every pair at distance <= reach is known
    for _ in range(max_rounds):
        longest = delta.agg(F.max("dist")).first()[0]
        if longest is None or longest < reach:
            break
        paths = reduce(DataFrame.unionByName, parts)
        # a pair at distance d in (reach, 2*reach] = a pair at distance exactly
        # `reach` (new in the previous round) followed by a known pair
        step = (delta.filter(F.col("dist") == reach).alias("d").join(paths.alias("p"), F.col("d.ancestor") == F.col("p.class_name"))
                .select(F.col("d.class_name").alias("class_name"), F.col("p.ancestor").alias("ancestor"),
                        (F.col("d.dist") + F.col("p.dist")).alias("dist")))
        new = materialize(
            step.filter(F.col("class_name") != F.col("ancestor"))
            .groupBy("class_name", "ancestor").agg(F.min("dist").alias("dist"))
            .join(paths, ["class_name", "ancestor"], "left_anti"),
            "isa-step",
        )
        parts.append(new)
        delta = new
        reach *= 2
    else:
        raise RuntimeError(f"IsA closure did not converge in {max_rounds} rounds")
    paths = reduce(DataFrame.unionByName, parts).select("class_name", "ancestor")
    names = classes.select("class_name").distinct()
    seed = names.select("class_name", F.col("class_name").alias("ancestor"))
    # inner join with the distinct names (= a semi join): a semi join would be
    # pushed below the union and shuffle the names once per round
    inherited = paths.join(names, "class_name", "inner")
    return seed.unionByName(inherited)


# --------------------------------------------------------------------------
# CLS2: role
# --------------------------------------------------------------------------

def _bits(ancestors) -> int:
    names = rule_ancestors()
    return sum(1 << names.index(a) for a in ancestors)


def isa_flags(class_bases: DataFrame, steps: int = 3) -> DataFrame:
    """``(class_name, isa_mask)``: one bit per rule ancestor that the class is
    or inherits from; classes without any are absent.

    The masks of the ~35 rule ancestors are carried down the base edges, so a
    class is one row however many ancestors it has, and no closure is built.
    A round is one job of ``steps`` edges' depth and sends down a frontier only:
    the bits that classes first got at the last depth of the round before.  The
    bits that a round adds are written under the checkpoint directory; known
    masks are joined once a round, to tell what is new, and never sent down
    again.  The loop ends when a round's last depth adds nothing.
    """
    spark = class_bases.sparkSession
    # the fixed names, each with its own bit
    seeds = spark.sql("SELECT inline(array(" + ", ".join(
        f"named_struct('class_name', '{n}', 'added', {1 << i}L, 'front', {1 << i}L)" for i, n in enumerate(rule_ancestors())) + "))")
    edges = materialize(class_bases.select("class_name", "base_name")
                        .filter(F.col("class_name").isNotNull() & F.col("base_name").isNotNull()).distinct(), "isa-flag-edges")
    parts = [seeds]
    while True:
        known = reduce(DataFrame.unionByName, parts).groupBy("class_name").agg(F.bit_or("added").alias("known"))
        level, levels = parts[-1].filter("front <> 0").select("class_name", F.col("front").alias("mask")), []
        for depth in range(steps):
            level = (edges.join(level.withColumnRenamed("class_name", "base_name"), "base_name")
                     .groupBy("class_name").agg(F.bit_or("mask").alias("mask")))
            levels.append(level.withColumn("last", F.lit(depth == steps - 1)))
        reached = reduce(DataFrame.unionByName, levels).groupBy("class_name").agg(
            F.bit_or("mask").alias("mask"), F.coalesce(F.bit_or(F.when(~F.col("last"), F.col("mask"))), F.lit(0).cast("bigint")).alias("early"))
        without = lambda mask, other: F.col(mask).bitwiseAND(F.bitwise_not(other))
        grown = reached.join(known, "class_name", "left").withColumn("added", without("mask", F.coalesce("known", F.lit(0).cast("bigint"))))
        part = materialize(grown.filter("added <> 0").select("class_name", "added", without("added", F.col("early")).alias("front")), "isa-flags")
        parts.append(part)
        if part.filter("front <> 0").isEmpty():
            break
    return reduce(DataFrame.unionByName, parts).groupBy("class_name").agg(F.bit_or("added").alias("isa_mask"))


def _isa_any(ancestors) -> Column:
    return F.coalesce(F.col("isa_mask"), F.lit(0).cast("bigint")).bitwiseAND(F.lit(_bits(ancestors)).cast("bigint")) != 0


def role_expr() -> Column:
    """CASE over ROLE_RULES.  Expects columns ``class_name``, ``known``,
    ``instantiable``, ``has_isa``, ``n_in``, ``n_out`` and ``isa_mask``."""
    name = F.col("class_name")
    algo = _isa_any([ALGORITHM])
    expr = None
    for (kind, *args), role in ROLE_RULES:
        if kind == "name_in":
            cond = name.isin(list(args[0]))
        elif kind == "unknown":
            cond = ~F.col("known")
        elif kind == "not_instantiable":
            cond = ~F.coalesce(F.col("instantiable"), F.lit(False))
            if args[0]:
                cond = cond & name.isin(list(args[0]))
        elif kind == "no_isa":
            cond = ~F.coalesce(F.col("has_isa"), F.lit(False))
        elif kind == "algo_name_in":
            cond = algo & name.isin(list(args[0]))
        elif kind == "algo_isa_any":
            cond = algo & _isa_any(args[0])
        elif kind == "isa_any":
            cond = _isa_any(args[0])
        elif kind == "name_contains":
            cond = F.lit(False)
            for part in args[0]:
                cond = cond | name.contains(part)
        elif kind == "name_starts":
            cond = name.startswith(args[0])
        elif kind == "algo_ports":
            n_in, n_out = F.coalesce(F.col("n_in"), F.lit(0)), F.coalesce(F.col("n_out"), F.lit(0))
            value = (
                F.when((n_in == 0) & (n_out > 0), F.lit("input"))
                .when((n_in > 0) & (n_out > 0), F.lit("filter"))
                .when((n_in > 0) & (n_out == 0), F.lit("output"))
                .otherwise(F.lit("filter"))
            )
            expr = F.when(algo, value) if expr is None else expr.when(algo, value)
            continue
        elif kind == "always":
            cond = F.lit(True)
        else:  # pragma: no cover - rules are fixed above
            raise ValueError(kind)
        expr = F.when(cond, F.lit(role)) if expr is None else expr.when(cond, F.lit(role))
    return expr


def class_facts(names: DataFrame, classes: DataFrame, flags: DataFrame) -> DataFrame:
    """``names(class_name)`` enriched with catalog facts and the masks of
    :func:`isa_flags`; classes
    absent from ``classes`` get ``known = false``."""
    # one fact row per class even if the table repeats a class: a partial
    # aggregation with a fixed choice (any true flag, the largest port count)
    c = classes.groupBy("class_name").agg(
        F.max("instantiable").alias("instantiable"), F.max("has_isa").alias("has_isa"),
        F.max("n_in").alias("n_in"), F.max("n_out").alias("n_out"), F.lit(True).alias("known"))
    return (
        names.select("class_name").distinct()
        .join(c, "class_name", "left")
        .join(flags, "class_name", "left")
        .withColumn("known", F.coalesce(F.col("known"), F.lit(False)))
    )


def roles(names: DataFrame, classes: DataFrame, flags: DataFrame) -> DataFrame:
    """CLS2: ``(class_name, role)`` for every distinct name."""
    return class_facts(names, classes, flags).select("class_name", role_expr().alias("role"))


# --------------------------------------------------------------------------
# CLS3, CLS4: port data types
# --------------------------------------------------------------------------

def normalize_types(types: Column | str) -> Column:
    """CLS4: non-empty type names comma-joined; null or no names -> ``""``."""
    t = F.col(types) if isinstance(types, str) else types
    return F.coalesce(
        F.array_join(F.filter(t, lambda x: x.isNotNull() & (x != "")), ","), F.lit("")
    )


def ports_from_text(ports: DataFrame, sep: str = "\n") -> DataFrame:
    """Port rows whose ``types`` is one newline-joined string -> array form."""
    return ports.withColumn("types", F.split(F.col("types"), sep, -1))


def port0_types(ports: DataFrame) -> DataFrame:
    """``(class_name, in_types, out_types)`` from port 0 of each direction."""
    return (
        ports.filter(F.col("port") == 0)
        .groupBy("class_name")
        .agg(
            F.max(F.when(F.col("direction") == "in", normalize_types("types"))).alias("in_types"),
            F.max(F.when(F.col("direction") == "out", normalize_types("types"))).alias("out_types"),
            F.max(F.col("direction") == "in").alias("has_in0"),
            F.max(F.col("direction") == "out").alias("has_out0"),
        )
    )


def datatypes_expr() -> tuple[Column, Column]:
    """CLS3 over class facts joined with :func:`port0_types`: only instantiable
    vtkAlgorithm descendants with IsA get types, and only for a direction
    whose port count is positive and whose port 0 is described."""
    gate = (
        F.col("known")
        & F.coalesce(F.col("instantiable"), F.lit(False))
        & F.coalesce(F.col("has_isa"), F.lit(False))
        & _isa_any([ALGORITHM])
    )
    inp = F.when(gate & (F.col("n_in") > 0), F.coalesce(F.col("in_types"), F.lit(""))).otherwise(F.lit(""))
    out = F.when(gate & (F.col("n_out") > 0), F.coalesce(F.col("out_types"), F.lit(""))).otherwise(F.lit(""))
    return inp, out


def datatypes(names: DataFrame, classes: DataFrame, flags: DataFrame, ports: DataFrame) -> DataFrame:
    """CLS3: ``(class_name, input_datatype, output_datatype)``."""
    inp, out = datatypes_expr()
    return (
        class_facts(names, classes, flags)
        .join(port0_types(ports), "class_name", "left")
        .select("class_name", inp.alias("input_datatype"), out.alias("output_datatype"))
    )


# --------------------------------------------------------------------------
# CLS5: semantic methods
# --------------------------------------------------------------------------

def semantic_methods(class_methods: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """CLS5 + ORD1: ``(class_name, semantic_methods)``: callable, non-boilerplate
    method names, distinct, in code-point order.  Classes with none are absent
    (callers left-join and default to ``[]``), and so are classes that are not
    in ``classes`` (None: all are known)."""
    if classes is not None:
        class_methods = class_methods.join(classes.select("class_name"), "class_name", "left_semi")
    return (
        class_methods.filter(F.col("is_callable") & ~is_boilerplate(F.col("method_name")))
        .groupBy("class_name")
        .agg(F.array_sort(F.collect_set("method_name")).alias("semantic_methods"))
    )


# --------------------------------------------------------------------------
# CLS6: full profile
# --------------------------------------------------------------------------

def profile(names: DataFrame, classes: DataFrame, flags: DataFrame, ports: DataFrame,
            class_methods: DataFrame) -> DataFrame:
    """CLS6: ``(class_name, role, input_datatype, output_datatype,
    semantic_methods)`` for every distinct name, with the unknown-class
    defaults ``utility, "", "", []``."""
    inp, out = datatypes_expr()
    return (
        class_facts(names, classes, flags)
        .join(port0_types(ports), "class_name", "left")
        .join(semantic_methods(class_methods, classes), "class_name", "left")
        .select(
            "class_name",
            role_expr().alias("role"),
            inp.alias("input_datatype"),
            out.alias("output_datatype"),
            F.coalesce(F.col("semantic_methods"), F.array().cast("array<string>")).alias("semantic_methods"),
        )
    )
