"""docferry: job-driven document exports on Spark.

The main entry points, importable from the package root:

* documents: ``DocumentView`` (nested frames, schemaless JSON, or a root table
  with lookups and child lists), ``json_documents``;
* jobs: ``project`` (paths -> flat text cells), ``matching`` /
  ``count_matching`` / ``count_per_job`` (job queries), ``validate_jobs``,
  ``load_job``, ``decode_control``;
* exports: ``run_export``, ``run_exports_one_scan``, ``run_one``,
  ``RunOptions``;
* streaming: ``control_stream.start`` with a ``StreamConfig``.
"""

from docferry.operators.control import decode_control
from docferry.operators.jobs import JobSpec, load_job, validate_jobs
from docferry.operators.projection import project
from docferry.operators.scan import count_matching, count_per_job, matching
from docferry.plans.job_run import RunOptions, run_export, run_exports_one_scan, run_one
from docferry.sources.documents import DocumentView, json_documents

__all__ = [
    "DocumentView", "JobSpec", "RunOptions", "count_matching", "count_per_job", "decode_control",
    "json_documents", "load_job", "matching", "project", "run_export", "run_exports_one_scan",
    "run_one", "validate_jobs",
]
