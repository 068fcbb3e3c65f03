"""End-to-end runs composed from the operators."""

from tallycheck.plans.dq_run import DQConfig, failing_keys, run_bronze_dq, run_checks
from tallycheck.plans.ingest import ingest, run_ingest

__all__ = ["DQConfig", "failing_keys", "run_bronze_dq", "run_checks", "ingest", "run_ingest"]
