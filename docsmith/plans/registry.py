"""All registered queries: importing the query modules fills the dicts."""

from docsmith.plans import queries as _q
from docsmith.plans import queries_catalog as _qc  # noqa: F401
from docsmith.plans import queries_jobs as _qj  # noqa: F401

QUERIES = _q.QUERIES
ORACLE = _q.ORACLE
