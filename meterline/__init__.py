"""meterline — Spark-native batch ELT analytics for taxi-style trip data.

Layout:
    sources/    scans (CSV, parquet, literal tables, month paths, the test adapter)
    functions/  Column -> Column helpers (fingerprints, keys, CASE maps, durations)
    operators/  DataFrame -> DataFrame operators (dedup, joins, merges, writes,
                exploration, data-quality checks, ML)
    plans/      the model layers built from operators (staging, star schema,
                interval reports, the warehouse month load)
    streaming/  exactly-once file ingest with Structured Streaming
"""

from meterline.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
