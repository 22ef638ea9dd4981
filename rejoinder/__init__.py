"""Orders joined with their returns, as Spark DataFrame jobs."""

from rejoinder.operators.enrich import enrich, join_returns
from rejoinder.plans.batch import BatchResult, run_batch
from rejoinder.plans.requests import accepted_batches, answer_requests
from rejoinder.session import build_session
from rejoinder.sources.csv import scan_csv
from rejoinder.sources.results import read_result
from rejoinder.streaming.landing import land_files, land_rows

__all__ = [
    "BatchResult",
    "accepted_batches",
    "answer_requests",
    "build_session",
    "enrich",
    "join_returns",
    "land_files",
    "land_rows",
    "read_result",
    "run_batch",
    "scan_csv",
]
