"""terrace: a medallion (bronze / silver / gold) lakehouse toolkit on PySpark.

Sub-packages
------------
sources    landing-file readers (CSV, JSON envelopes) and table I/O by path
functions  column-level cleaning helpers (tolerant casts, dates, text, recodes, names)
operators  DataFrame-level operators (shaping, de-duplication, keys, star schemas, profiling)
plans      declarative bronze -> silver -> gold specifications for the six subject areas
streaming  incremental landing-zone ingest with Structured Streaming (available-now trigger)
"""

from terrace.session import build_session, configure, shared_dir

__all__ = ["build_session", "configure", "shared_dir"]
