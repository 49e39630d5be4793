"""Stub annotation (JOB3, JN5, JN6, FLT8, AGG9).

A stub is one text per module.  Every class declaration line
``class <Name>...:`` of a module whose record has a non-empty docstring gets
``    \"\"\"<docstring>\"\"\"`` inserted before the next non-blank line after
it (so after any blank lines that follow), unless that line already opens a
docstring.  Stubs of modules without records pass through unchanged.

Plan: stubs are hash-partitioned by module once and exploded into lines.
Declarations and their insertion points come from one descending running
window over a module's lines (the next non-blank line below each line); only
the declaration rows (one per class) are joined with the docstrings, by
``(module, class)``.  A file is rebuilt from its lines and the docstrings among
them in blocks of lines, so that no task orders a whole file's lines to join them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsmith.functions.text import is_blank, py_lstrip
from docsmith.operators.filters import annotatable
from docsmith.operators.labelling import latest_per_key

# A declaration: the class name is a whole word, no colon until the final one,
# only whitespace after it.
DECL_RE = r"(?U)class (\w+)\b[^:]*:\s*$"


# File identity: a hash of the text (deterministic under task retries), so two
# different files of one module are never mixed line by line; exact copies
# of a file collapse into one.
FILE_ID = "_file"
#: Lines of a block of a file.
BLOCK_LINES = 10_000


def with_file_id(stubs: DataFrame) -> DataFrame:
    if FILE_ID in stubs.columns:
        return stubs
    return stubs.withColumn(FILE_ID, F.xxhash64(F.coalesce(F.col("content"), F.lit(""))))


def stub_lines(stubs: DataFrame) -> DataFrame:
    """``(module_name, _file, pos, line)`` of every stub, order and empties kept."""
    return with_file_id(stubs).select(
        "module_name", FILE_ID,
        F.posexplode(F.split(F.coalesce(F.col("content"), F.lit("")), "\n", -1)).alias("pos", "line"),
    ).withColumn("pos", F.col("pos").cast("bigint"))


def declarations(lines: DataFrame) -> DataFrame:
    """JN6 input: first declaration line per ``(module, class)`` with its
    insertion point and whether a docstring is already there."""
    below = Window.partitionBy("module_name", FILE_ID).orderBy(F.col("pos").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy("module_name", FILE_ID)
    decl_name = F.regexp_extract(F.col("line"), DECL_RE, 1)
    marked = (
        lines.withColumn("next_text", F.min(F.when(~is_blank("line"), F.struct("pos", "line"))).over(below))
        .withColumn("last_pos", F.max("pos").over(whole))
        .withColumn("decl", F.when(decl_name != "", decl_name))
    )
    decls = marked.filter(F.col("decl").isNotNull() & (F.col("pos") < F.col("last_pos")))
    first = decls.groupBy("module_name", FILE_ID, F.col("decl").alias("class_name")).agg(
        F.min_by(F.struct("pos", "next_text", "last_pos"), F.col("pos")).alias("d"))
    nxt = F.col("d.next_text")
    return first.select(
        "module_name", FILE_ID, "class_name",
        F.col("d.pos").alias("decl_pos"),
        F.coalesce(nxt["pos"], F.col("d.last_pos")).alias("insert_pos"),
        F.coalesce(
            py_lstrip(nxt["line"]).startswith('"""') | py_lstrip(nxt["line"]).startswith("'''"),
            F.lit(False),
        ).alias("has_docstring"),
    )


def stub_docs(records: DataFrame, order_col: str | None = None) -> DataFrame:
    """One docstring per ``(module, class)``: the last record by ``order_col``,
    or (no order) the greatest docstring, so repeated records never insert
    two docstrings at one declaration."""
    if order_col:
        return latest_per_key(records.select("module_name", "class_name", "class_doc", order_col),
                              ["module_name", "class_name"], order_col)
    return records.groupBy("module_name", "class_name").agg(F.max("class_doc").alias("class_doc"))


def annotate_stubs(stubs: DataFrame, records: DataFrame, order_col: str | None = None) -> DataFrame:
    """JOB3: ``(module_name, path, content, inserted)`` per stub file.

    The declarations found in the exploded lines are joined with the
    docstrings: one small row per inserted docstring, which takes its place
    among the lines.  Blocks of ``BLOCK_LINES`` lines are joined to text each,
    wherever they are dealt, and a file's text from its blocks; a docstring is
    never looked up for a line, so the work grows with the lines."""
    docs = stub_docs(records, order_col)
    src = with_file_id(stubs.select("module_name", "content")).dropDuplicates(["module_name", FILE_ID])
    lines = stub_lines(src)
    inserts = (
        declarations(lines)
        .filter(~F.col("has_docstring"))
        .join(annotatable(docs).select("module_name", "class_name", "class_doc"),
              ["module_name", "class_name"])
        .select("module_name", FILE_ID, F.col("insert_pos").alias("pos"),
                F.concat(F.lit('    """'), F.col("class_doc"), F.lit('"""')).alias("line"), F.lit(0).alias("sub"))
    )
    blocks = (
        lines.withColumn("sub", F.lit(1)).unionByName(inserts)
        .withColumn("block", F.expr(f"pos div {BLOCK_LINES}"))
        .repartition("module_name", FILE_ID, "block")
        .groupBy("module_name", FILE_ID, "block")
        .agg(F.expr("listagg(line, '\\n') within group (order by pos, sub)").alias("text"), F.count_if(F.col("sub") == 0).alias("n"))
    )
    # the text a file was given comes with its blocks, not by a join, and a file's text
    # is made in the aggregation's own projection: either would copy the whole text again
    files = blocks.select("module_name", FILE_ID, "n", F.struct("block", "text").alias("block")).unionByName(src, allowMissingColumns=True)
    rebuilt = F.concat_ws("\n", F.array_sort(F.collect_list("block")).getField("text"))
    return files.groupBy("module_name", FILE_ID).agg(
        F.concat("module_name", F.lit(".pyi")).alias("path"),
        F.when(F.sum("n") == 0, F.max("content")).otherwise(rebuilt).alias("content"),
        F.sum("n").alias("inserted"),
    ).drop(FILE_ID)


def stub_summary(annotated: DataFrame) -> DataFrame:
    """AGG9: files written / total, files that got docstrings, docstrings.  A
    file with an ``error`` is not written; one that is copied as it was is."""
    failed = F.col("error").isNotNull() if "error" in annotated.columns else F.lit(False)
    return annotated.agg(
        F.count_if(~failed).alias("files_written"),
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(~failed & (F.col("inserted") > 0)).alias("files_annotated"),
        F.coalesce(F.sum(F.when(~failed, F.col("inserted"))), F.lit(0)).cast("bigint").alias("docstrings_inserted"),
    )


# --------------------------------------------------------------------------
# Line-level path: the build's own, for stub files of any size
# --------------------------------------------------------------------------

#: Why a stub file fails.
NOT_UTF8 = "not UTF-8"
_BOM = "\ufeff"


def text_line_rows(stubs: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Line rows, as ``io.read_stub_lines`` gives them, of stub texts
    ``(module_name, content)``; a null text is an empty file.  Exact copies of a
    file are one."""
    text = F.coalesce("content", F.lit(""))
    src = with_file_id(stubs.select("module_name", "content")).dropDuplicates(["module_name", FILE_ID])
    # a file's facts stand below the explode: beside it they are worked out, from the whole text, for every line
    files = src.select(
        "module_name", F.concat_ws("#", "module_name", F.hex(FILE_ID)).alias("file"), F.octet_length(text).cast("bigint").alias("file_size"),
        F.split(text, "\n", -1).alias("_lines"), F.size(F.split(text, "\n", -1)).alias("_n"))
    lines = files.select("module_name", "file", "file_size", "_n", F.posexplode("_lines").alias("pos", "line"))
    after_newline = (F.col("pos") == F.col("_n") - 1) & (F.col("line") == "") & (F.col("file_size") > 0)
    return lines.filter(~after_newline).select(
        "module_name", "file", F.floor(F.col("pos") / block_lines).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("row"), "line", "file_size")


#: Piece of a block: a split of a file can have any number of lines.
PIECE = "_piece"


def with_piece(lines: DataFrame) -> DataFrame:
    return lines if PIECE in lines.columns else lines.withColumn(PIECE, F.expr(f"row div {BLOCK_LINES}"))


def stub_blocks(lines: DataFrame, modules: DataFrame) -> DataFrame:
    """What a file's lines must know of the rest of it, one row per ``(file,
    block, _piece)``: ``next_nb``, the first line with text in a later one; ``last``,
    the file's last line; ``tail_nl``, 1 if a newline ends the file; ``bom_row``,
    the line before which the text source drops a byte order mark; ``error``.
    The windows are over the pieces of a file's blocks, not its lines.

    The bytes that lines and the newlines between them leave of the file's size
    tell the final newline (1 byte) and the mark (3)."""
    first_line = F.min(F.when(~is_blank("line"), F.struct("row", "line")))
    blocks = with_piece(lines).groupBy("module_name", "file", "block", PIECE).agg(
        first_line.alias("nb"), F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.first("file_size").alias("file_size"),
        F.sum(F.octet_length("line") + 1).alias("octets"), F.count_if(~F.is_valid_utf8("line")).alias("bad"))
    whole = Window.partitionBy("file").orderBy("block", PIECE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = Window.partitionBy("file").orderBy(F.col("block").desc(), F.col(PIECE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    start = F.struct("block", "first_row")
    spare = F.max("file_size").over(whole) - (F.sum("octets").over(whole) - 1)
    known = modules.select("module_name").distinct().withColumn("known", F.lit(True))
    facts = blocks.select(
        "module_name", "file", "block", PIECE,
        F.min(F.when(F.col("nb").isNotNull(), F.struct("block", F.col("nb.row").alias("row"), F.col("nb.line").alias("line")))).over(later).alias("next_nb"),
        F.max(F.struct("block", F.col("last_row").alias("row"))).over(whole).alias("last"),
        (spare % 3).alias("tail_nl"), F.when((spare >= 3) & (start == F.min(start).over(whole)), F.col("first_row")).alias("bom_row"), F.sum("bad").over(whole).alias("bad"))
    # a file of a module without records is copied as it is, whatever its bytes
    return facts.join(known, "module_name", "left").withColumn("error", F.when((F.col("bad") > 0) & F.col("known"), F.lit(NOT_UTF8))).drop("bad", "known")


def annotate_stub_lines(lines: DataFrame, records: DataFrame, order_col: str | None = None) -> DataFrame:
    """JOB3 over line rows ``(module_name, file, block, row, line, file_size)``
    (see ``io.read_stub_lines``); returns the annotated files as line rows
    ``(module_name, file, block, row, sub, line, nl, error)``: a file is its
    lines in ``(block, row, sub)`` order, each followed by a newline where
    ``nl``.  ``error`` is set on all lines of a file that fails: a file whose
    module has records must be UTF-8.

    Nothing gathers a file, or a large split of one: lines are distributed by
    ``(file, block)`` and, within it, by pieces of ``BLOCK_LINES`` lines.  The
    next non-blank line after a declaration is found by a window within its
    piece, and for a declaration whose piece ends in blank lines in the piece's
    facts (:func:`stub_blocks`), which are joined by the same key."""
    key = F.struct("block", "row")
    lines = with_piece(lines).repartition("file", "block", PIECE)  # once, for the facts and the lines
    in_block = Window.partitionBy("file", "block", PIECE).orderBy(F.col("row").desc()).rowsBetween(Window.unboundedPreceding, -1)
    marked = (
        lines.join(stub_blocks(lines, records).drop("module_name"), ["file", "block", PIECE])
        .withColumn("decl", F.when(F.col("error").isNull(), F.regexp_extract("line", DECL_RE, 1)))
        .withColumn("nb", F.min(F.when(~is_blank("line"), F.struct("row", "line"))).over(in_block))
    )
    decls = (
        marked.filter((F.col("decl") != "") & ((F.col("tail_nl") == 1) | (key != F.col("last"))))  # not the file's last piece
        .groupBy("module_name", "file", F.col("decl").alias("class_name"))
        .agg(F.min_by(F.struct("block", "row", "nb", "next_nb", "last", "tail_nl"), key).alias("d"))
    )
    nb_block = F.when(F.col("d.nb").isNotNull(), F.col("d.block")).otherwise(F.col("d.next_nb.block"))
    nb_line = F.coalesce(F.col("d.nb.line"), F.col("d.next_nb.line"))
    # no non-blank line below: before the last piece -- after the last line when
    # a newline ends the file (the last piece is then the empty text after it)
    sub = F.when(nb_block.isNull() & (F.col("d.tail_nl") == 1), F.lit(2)).otherwise(F.lit(0))
    has_doc = F.coalesce(py_lstrip(nb_line).startswith('"""') | py_lstrip(nb_line).startswith("'''"), F.lit(False))
    docs = annotatable(stub_docs(records, order_col).select("module_name", "class_name", "class_doc"))
    inserts = (
        decls.filter(~has_doc)
        .join(docs, ["module_name", "class_name"])
        .select("module_name", "file", F.coalesce(nb_block, F.col("d.last.block")).alias("block"),
                F.coalesce("d.nb.row", "d.next_nb.row", "d.last.row").alias("row"), sub.alias("sub"),
                F.concat(F.lit('    """'), F.col("class_doc"), F.lit('"""')).alias("line"), F.lit(True).alias("nl"), F.lit(None).cast("string").alias("error"))
    )
    originals = marked.select(
        "module_name", "file", "block", "row", F.lit(1).alias("sub"), F.concat(F.when(F.col("row") == F.col("bom_row"), F.lit(_BOM)).otherwise(F.lit("")), "line").alias("line"),
        ((key != F.col("last")) | (F.col("tail_nl") == 1)).alias("nl"), "error")
    return originals.unionByName(inserts)


def stub_files(annotated_lines: DataFrame) -> DataFrame:
    """One row per stub file of line rows: ``(module_name, path, inserted, error)``."""
    # a maximum of strings sorts its input: that of the lines is counted by error first
    counts = annotated_lines.groupBy("module_name", "file", "error").agg(F.count_if(F.col("sub") != 1).alias("inserted"))
    files = counts.groupBy("module_name", "file").agg(F.sum("inserted").alias("inserted"), F.max("error").alias("error"))
    return files.select("module_name", F.concat("module_name", F.lit(".pyi")).alias("path"), "inserted", "error")


def write_outcomes(files: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``files`` (see :func:`stub_files`) with the outcome of their writing
    (``io.file_outcomes``): a file that the sink has not written has an error."""
    missing = F.when(F.col("bytes").isNull(), F.lit("not written"))
    own = files.withColumnRenamed("error", "_error").join(outcomes, "path", "left")
    return own.select("module_name", "path", "inserted", F.coalesce("_error", "error", missing).alias("error"))


def write_stub_lines(annotated_lines: DataFrame, path: str) -> None:
    """Annotated stub line rows, globally sorted (range-partitioned), so the
    parts read in order give each file's text; no file is gathered by one task."""
    (annotated_lines.orderBy("module_name", "file", "block", "row", "sub")
     .write.mode("overwrite").parquet(path))
