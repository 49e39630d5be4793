"""Sources and sinks (SRC1-SRC5, SNK1-SNK4; files as such: :mod:`docsmith.sources.files`).

All readers pass an explicit schema (no inference pass over the data) and
return DataFrames whose scans prune columns and push filters.  ``missing_ok``
turns a missing path into an empty DataFrame (pages and stubs), otherwise
the error propagates (stats and search report it).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsmith.functions.text import bare_module
from docsmith.operators.labelling import dedupe_label_cache
from docsmith.operators.pages import INDEX_FILE
from docsmith.operators.stubs import BLOCK_LINES
from docsmith.schema import HELP_DUMP, LABEL, RECORD, STUB_LINES, STUBS
from docsmith.sources.files import together, write_files, write_files_in_pieces


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def file_order():
    """Sortable position of a row in its source files."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_records(spark: SparkSession, path: str, missing_ok: bool = False,
                 with_seq: bool = False, with_flags: bool = False) -> DataFrame:
    """SRC1/SRC2: JSON-lines records with the catalog defaults for missing
    fields (``module_name`` -> ``unknown``, ``class_name`` -> ``""``).
    ``with_seq`` adds a file-order key ``seq``: (file path, start of the
    file split, row id).  Row ids grow within a task's scan, so the triple
    orders rows as they appear in the files whatever the task layout.
    ``with_flags`` adds ``score_null``: the score is given, as null (an absent
    one is not).  Blank lines are skipped; any other line that is not a JSON
    object of this schema fails the read."""
    try:
        if with_flags:
            lines = spark.read.text(path).filter(F.btrim("value") != "")
            row = F.from_json("value", RECORD, {"mode": "FAILFAST"})
            df = lines.select(row.alias("r"), "value", *([file_order().alias("seq")] if with_seq else []))
            flag = F.col("r.visibility_score").isNull() & F.array_contains(F.json_object_keys("value"), "visibility_score")
            df = df.select("r.*", F.coalesce(flag, F.lit(False)).alias("score_null"), *(["seq"] if with_seq else []))
        else:
            df = spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)
            df = df.withColumn("seq", file_order()) if with_seq else df
        df.schema  # noqa: B018 - force path resolution
    except AnalysisException as e:
        if missing_ok and _missing(e):
            return _empty(spark, RECORD)
        raise
    df = (df.withColumn("module_name", F.coalesce(F.col("module_name"), F.lit("unknown")))
          .withColumn("class_name", F.coalesce(F.col("class_name"), F.lit(""))))
    return df


def read_label_cache(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """SRC3: label cache JSON lines; blank lines are skipped by the JSON
    reader; the last row per class (in file order) wins.  A line that is not
    JSON, or has no class name, fails the read."""
    try:
        df = spark.read.schema(LABEL).option("mode", "FAILFAST").json(path)
        df.schema  # noqa: B018
    except AnalysisException as e:
        if missing_ok and _missing(e):
            return _empty(spark, LABEL)
        raise
    unnamed = F.raise_error(F.lit("a label cache line has no class_name")).cast("string")
    df = df.withColumn("class_name", F.coalesce("class_name", unnamed)).withColumn("seq", file_order())
    return dedupe_label_cache(df, "seq")


def _whole_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """One row per file: ``(file_path, file_name, text)``, the bytes decoded as
    UTF-8 exactly (the text source's whole-file mode drops a final newline)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    return df.select(
        F.col("path").alias("file_path"),
        F.regexp_extract(F.col("path"), r"([^/]*)$", 1).alias("file_name"),
        F.decode(F.col("content"), "UTF-8").alias("text"),
    )


def _empty_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(file_path, file_name) of the files directly in ``path`` that have no
    bytes: file scans leave them out, the file listing has them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    listed = [(f, unquote(f.rpartition("/")[2])) for f in files.inputFiles()]
    return spark.createDataFrame(listed, "file_path string, file_name string").join(
        files.filter("length > 0").select(F.col("_metadata.file_name").alias("file_name")), "file_name", "left_anti")


def read_help_dump(spark: SparkSession, path: str, fmt: str = "parquet", with_seq: bool = False) -> DataFrame:
    """SRC4: help dump ``(module_name, class_name, help_text)``.

    ``fmt='parquet'`` reads a table with those columns.  ``fmt='text'`` reads
    one file per class laid out as ``<module>/<class>.txt`` (whole file = one
    text; module and class from the path).  ``with_seq`` adds the ingestion order
    ``seq`` (:func:`file_order`), which the parse and the build carry along, so
    that of two texts of a class the last one wins."""
    if fmt == "text":
        df = _whole_files(spark, path)
        return df.select(
            bare_module(F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1)).alias("module_name"),
            F.regexp_extract("file_name", r"^(.*?)(\.[^.]*)?$", 1).alias("class_name"),
            F.col("text").alias("help_text"),
            *([F.struct(F.col("file_path").alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row")).alias("seq")]
              if with_seq else []),
        )
    df = spark.read.schema(HELP_DUMP).parquet(path)
    df = df.withColumn("seq", file_order()) if with_seq else df
    return df.withColumn("module_name", bare_module("module_name"))


def read_stubs(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """SRC5: every ``*.pyi`` directly in ``path``; module = file stem."""
    try:
        df = _whole_files(spark, path, glob="*.pyi")
        df.schema  # noqa: B018
    except AnalysisException as e:
        if missing_ok and _missing(e):
            return _empty(spark, STUBS)
        raise
    read = df.select(
        F.regexp_extract("file_name", r"^(.*)\.pyi$", 1).alias("module_name"),
        F.col("text").alias("content"),
    )
    return read.unionByName(_empty_files(spark, path, "*.pyi").select(
        F.regexp_extract("file_name", r"^(.*)\.pyi$", 1).alias("module_name"), F.lit("").alias("content")))


def write_records(records: DataFrame, path: str, order_col: str | None = None) -> None:
    """SNK1: one JSON object per record; nulls written, non-ASCII kept.  With
    ``order_col`` the lines are in that order over all files (range partitions),
    so that a reader for whom the last line of a class wins (``with_seq``) sees
    the record that the order makes the last."""
    if order_col:
        records = records.repartitionByRange(order_col).sortWithinPartitions(order_col)
    (records.select(*[f.name for f in RECORD.fields]).write.mode("overwrite")
     .option("ignoreNullFields", "false").json(path))


def write_label_cache(labels: DataFrame, path: str) -> None:
    """SNK2: the four label-cache fields."""
    (labels.select("class_name", "synopsis", "action_phrase", "visibility_score")
     .write.mode("overwrite").option("ignoreNullFields", "false").json(path))


def write_stubs(annotated: DataFrame, path: str) -> None:
    """SNK3: annotated stub texts, replacing any previous output."""
    annotated.select("module_name", "path", "content").write.mode("overwrite").parquet(path)


def write_stub_files(annotated_lines: DataFrame, path: str) -> None:
    """SNK3 as files, one ``.pyi`` a module, from the line rows of
    ``stubs.annotate_stub_lines``: all files are replaced together, and a file
    with an error is left out (its outcome says why).  A file is written in
    pieces of lines, so that no task orders the lines of a whole one."""
    piece = F.format_string("%020d-%020d", "block", F.expr(f"row div {BLOCK_LINES}"))
    rows = annotated_lines.withColumn("path", F.concat("module_name", F.lit(".pyi"))).withColumn("piece", piece)
    data = F.concat(F.col("line").cast("binary"), F.when(F.col("nl"), F.lit("\n")).otherwise(F.lit("")).cast("binary"))
    good = rows.filter(F.col("error").isNull()).withColumn("data", data).withColumn("owner", F.col("file"))
    failed = rows.filter(F.col("error").isNotNull()).select("path", "error").distinct().groupBy("path").agg(F.min("error").alias("error"))
    write_files_in_pieces(good, path, ["file", "block", "row", "sub"], failed)


def page_files(pages: DataFrame, *indexes: DataFrame) -> DataFrame:
    """Rows of the file sink: a file for each page, and one for each index from
    its line rows.  A page that has the name of an index gives way to it."""
    lines = indexes[0].select("path", "kind", "sort_key", "line")
    for more in indexes[1:]:
        lines = lines.unionByName(more.select("path", "kind", "sort_key", "line"))
    begins = (F.col("kind") == 0) & (F.col("sort_key") == "00")
    lines = together(lines, "kind", "sort_key").select("path", F.when(begins, F.col("line")).otherwise(F.concat(F.lit("\n"), F.col("line"))).alias("data"))
    own = pages.filter(F.substring_index("path", "/", -1) != INDEX_FILE)
    return own.select("path", F.col("content").alias("data")).unionByName(lines)


def write_page_files(pages: DataFrame, module_index: DataFrame, main_index: DataFrame, path: str) -> None:
    """SNK4 as files: ``<module>/<class>.md``, ``<module>/index.md`` and
    ``index.md`` under the folder ``path``, which is replaced as a whole once
    all are written (see :mod:`docsmith.sources.files`)."""
    write_files(page_files(pages, module_index, main_index), path)


def write_pages(pages: DataFrame, path: str) -> None:
    """SNK4: pages as rows ``(module_name, path, content)``, partitioned by
    module so a module's pages can be read back (or pruned) on their own.
    Pages are dealt in ranges of (module, path) first: a task writes few
    modules, and a hot module is split over several tasks."""
    (pages.select("module_name", "path", "content").repartitionByRange("module_name", "path").write.mode("overwrite")
     .partitionBy("module_name").parquet(path))


def write_lines(lines: DataFrame, path: str, sort_cols: list[str]) -> None:
    """Index pages as line rows, globally sorted (range-partitioned), so
    reading the parts in order yields the page text."""
    lines.orderBy(*sort_cols).write.mode("overwrite").parquet(path)


def write_help_dump_bucketed(help_dump: DataFrame, table: str, buckets: int) -> None:
    """Store a help dump as a table bucketed (and sorted) on the document key.
    Reading it back gives scans that are already hash-partitioned on
    ``(module_name, class_name)``, so :func:`docsmith.operators.helpparse.
    structured_docs` with ``prepartitioned=True`` parses with no shuffle."""
    (help_dump.select(bare_module("module_name").alias("module_name"), "class_name", "help_text")
     .write.mode("overwrite").bucketBy(buckets, "module_name", "class_name")
     .sortBy("module_name", "class_name").saveAsTable(table))


def read_stub_lines(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """SRC5, line by line: every ``*.pyi`` directly in ``path`` as rows
    ``(module_name, file, block, row, line, file_size)``.  Files are split
    like any text input, so a huge stub file is read by many tasks;
    ``(file, block, row)`` orders a file's lines (row ids grow within a split).
    Lines are separated by ``\\n`` only, as ``str.split('\\n')`` does; a line keeps
    its bytes, also such as are no UTF-8.  A file that is empty but for a byte
    order mark, which has no line for the text source, is one empty line."""
    options = {"pathGlobFilter": "*.pyi", "recursiveFileLookup": "false"}
    try:
        lines = spark.read.options(**options).option("lineSep", "\n").text(path)
        files = spark.read.format("binaryFile").options(**options).load(path)
        lines.schema, files.schema  # noqa: B018
    except AnalysisException as e:
        if missing_ok and _missing(e):
            return _empty(spark, STUB_LINES)
        raise
    module = lambda name: F.regexp_extract(name, r"^(.*)\.pyi$", 1).alias("module_name")
    read = lines.select(
        module("_metadata.file_name"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    one_line = [F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row"), F.lit("").alias("line")]
    mark = files.filter(F.col("length") == 3).filter(F.col("content") == b"\xef\xbb\xbf").select(
        module("_metadata.file_name"), F.col("_metadata.file_path").alias("file"), *one_line, F.col("length").alias("file_size"))
    none = _empty_files(spark, path, "*.pyi").select(module("file_name"), F.col("file_path").alias("file"), *one_line, F.lit(0).cast("bigint").alias("file_size"))
    return read.unionByName(mark).unionByName(none)
