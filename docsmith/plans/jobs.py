"""End-to-end build (JOB10): catalog -> labels -> records -> stubs -> pages.

Each stage writes its output under ``out_dir`` (a shared filesystem path on a
cluster) and the next stage reads it back, so a stage never recomputes the
previous ones and a lost executor only repeats work of the running stage.
Stages: ``catalog`` (parse, written; role flags and profile computed
alongside), ``labels`` (cache + labeller over the parsed docs, written),
``records`` (parsed docs + profile + labels, written as JSON), ``stubs`` (one
file a module), ``pages`` (class pages, module results, index line
rows, and one file a page and index).

Where the dump has an ingestion order (``seq``, see ``io.read_help_dump``), the
last of a class's texts wins in everything made from the records, and the JSON
lines are in that order.  A stub file that cannot be annotated is left out and
counted; the others are written.  Stub and page files replace the previous ones
only when all are written.
A failing stage stops the build (the exception propagates after the stage
name is recorded), like the reference's stop-at-first-failure sequence.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from docsmith.operators import catalog as CT
from docsmith.operators import helpparse as hp
from docsmith.operators import labelling as LL
from docsmith.operators import pages as PG
from docsmith.operators import stubs as SB
from docsmith.schema import KEY_METHODS_SHOWN, MAX_DOC_CHARS
from docsmith.session import scratch_scope
from docsmith.sources import io as IO
from docsmith.sources.files import file_outcomes


@dataclass
class BuildResult:
    ok: bool = False
    stages: list[str] = field(default_factory=list)
    seconds: dict = field(default_factory=dict)
    failed_stage: str | None = None
    summary: dict = field(default_factory=dict)


def build_all(spark: SparkSession, *args, **options) -> BuildResult:
    """Run every stage (see :func:`_build` for the arguments) and remove the
    intermediate files of the role flags."""
    with scratch_scope(spark):
        return _build(spark, *args, **options)


def _build(
    spark: SparkSession,
    help_dump: DataFrame,
    classes: DataFrame,
    class_bases: DataFrame,
    ports: DataFrame,
    class_methods: DataFrame,
    out_dir: str,
    stubs: DataFrame | str | None = None,
    label_cache: DataFrame | None = None,
    labeller: LL.Labeller | None = None,
    label_concurrency: int | None = None,
    version: str = "VTK (version unknown)",
    prepartitioned: bool = False,
    stub_lines: DataFrame | None = None,
    max_doc_chars: int = MAX_DOC_CHARS,
    shown_methods: int = KEY_METHODS_SHOWN,
) -> BuildResult:
    """Run every stage; returns which stages finished and summary counts.
    ``stubs``: a folder of stub files, which are read by lines in splits, or rows
    ``(module_name, content)``; ``stub_lines``: line rows in their place."""
    res = BuildResult()
    out = out_dir.rstrip("/")
    if isinstance(stubs, str):
        stub_lines = IO.read_stub_lines(spark, stubs)
    elif stubs is not None:
        stub_lines = SB.text_line_rows(stubs)
    order = hp.SEQ if hp.SEQ in help_dump.columns else None

    clock = {"t": time.perf_counter()}

    def stage(name):
        now = time.perf_counter()
        if res.stages:
            res.seconds[res.stages[-1]] = round(now - clock["t"], 3)
        clock["t"] = now
        res.failed_stage = name
        return name

    try:
        stage("catalog")
        # The parse and the role flags are independent: the parse's job runs
        # from a second thread while the flags' small rounds run here, so
        # the cluster's slots are shared by both (concurrent jobs, one context).
        with ThreadPoolExecutor(max_workers=1) as pool:
            parsed = pool.submit(
                lambda: CT.build_catalog(help_dump, profile=None, labels=None, prepartitioned=prepartitioned)
                .drop("matched")
                .write.mode("overwrite").parquet(f"{out}/stage/parsed"))
            profile = CT.catalog_profile(classes, class_bases, ports, class_methods)
            parsed.result()
        res.stages.append("catalog")

        stage("labels")
        base = spark.read.parquet(f"{out}/stage/parsed").drop(
            "role", "input_datatype", "output_datatype", "semantic_methods")
        labels = LL.label_classes(base, label_cache, labeller=labeller, order_col=order, concurrency=label_concurrency,
                                  max_doc_chars=max_doc_chars)
        labels.write.mode("overwrite").parquet(f"{out}/stage/labels")
        res.stages.append("labels")

        stage("records")
        labels = spark.read.parquet(f"{out}/stage/labels")
        records = LL.apply_labels(CT.attach_profile(base, profile), labels)
        # Parquet for the next stages (columns prune), JSON as the output
        records.write.mode("overwrite").parquet(f"{out}/stage/records")
        records = spark.read.parquet(f"{out}/stage/records")
        IO.write_records(records, f"{out}/records", order)
        # one record per class for everything rendered from here on
        PG.current_records(records, order).write.mode("overwrite").parquet(f"{out}/stage/current")
        recs = spark.read.parquet(f"{out}/stage/current")
        res.stages.append("records")

        if stub_lines is not None:
            stage("stubs")
            SB.annotate_stub_lines(stub_lines, recs).write.mode("overwrite").parquet(f"{out}/stage/stub_lines")
            annotated = spark.read.parquet(f"{out}/stage/stub_lines")
            IO.write_stub_files(annotated, f"{out}/stubs")
            written = SB.write_outcomes(SB.stub_files(annotated), file_outcomes(spark, f"{out}/stubs"))
            res.summary["stubs"] = SB.stub_summary(written).first().asDict()
            res.stages.append("stubs")

        stage("pages")
        IO.write_pages(PG.module_pages(recs, shown_methods=shown_methods), f"{out}/pages")
        results = PG.module_results(recs)
        results.write.mode("overwrite").parquet(f"{out}/stage/module_results")
        results = spark.read.parquet(f"{out}/stage/module_results")
        IO.write_lines(PG.module_index_lines(recs), f"{out}/module_index", ["module_name", "kind", "sort_key"])
        IO.write_lines(PG.main_index_lines(results, version), f"{out}/main_index", ["kind", "sort_key"])
        module_index = spark.read.parquet(f"{out}/module_index").join(results.filter("status = 'success'"), "module_name", "left_semi")
        if not results.isEmpty():  # without records the previous files stay
            IO.write_page_files(spark.read.parquet(f"{out}/pages"), module_index, spark.read.parquet(f"{out}/main_index"), f"{out}/markdown")
        res.summary["pages"] = PG.build_summary(results).first().asDict()
        res.summary["catalog"] = CT.stats(records).first().asDict()
        res.summary["labels"] = LL.label_coverage(records).first().asDict()
        res.stages.append("pages")
        res.seconds["pages"] = round(time.perf_counter() - clock["t"], 3)
        res.failed_stage = None
        res.ok = True
    except Exception:
        res.ok = False
        raise
    return res
