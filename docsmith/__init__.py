"""docsmith: API-documentation catalogs built and queried with PySpark.

The main entry points:

* :func:`docsmith.operators.catalog.build_catalog` -- help dump -> records
* :func:`docsmith.operators.catalog.catalog_profile` -- class roles, types, methods
* :func:`docsmith.operators.labelling.label_classes` -- cache + labeller
* :func:`docsmith.operators.pages.class_page`, ``module_index_lines``, ``main_index_lines``
* :func:`docsmith.operators.stubs.annotate_stubs`
* :func:`docsmith.operators.catalog.search`, ``stats``, ``export_label_cache``
* :func:`docsmith.plans.jobs.build_all` -- the staged end-to-end build
"""

__version__ = "0.1.0"
