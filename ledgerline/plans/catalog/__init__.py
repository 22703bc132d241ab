"""Importing this package registers every query."""

from ledgerline.plans.catalog import (  # noqa: F401
    scans,
    quality,
    features,
    summaries,
    statistics,
    samples,
    evaluation,
    learners,
)
