"""claimlens — insurance portfolio analytics expressed as Spark DataFrame operators.

Layout
------
functions/   Column -> Column helpers (null-safe clip, safe division, parsers,
             bins, labels) and pure-Python distribution tails for test finishes.
sources/     scans and sinks (raw pipe files, parquet, reports) and the
             ``policy`` view built from the star-schema test tables.
operators/   DataFrame -> DataFrame operators: cleaning, features, profiles,
             segments, trends, distributed ranks, hypothesis tests, ML, pricing.
plans/       composed jobs: the ETL pipeline, the hypothesis battery, the
             frequency-severity modelling pipeline.
streaming/   the chunked raw ingestion re-expressed as a Structured Streaming job.
"""

from claimlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
