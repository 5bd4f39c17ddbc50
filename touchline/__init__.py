"""touchline: a Spark-native sports-analytics engine.

Landed stat feeds become a partitioned lake, identities from many sources
resolve to one stable key, and season-level questions (projections, grading,
band calibration, value-over-replacement boards) run as DataFrame plans.

Layout:
    sources/    scans, sinks and literal rule tables
    functions/  column-level helpers (codes, casts, clamps, labels)
    operators/  reusable DataFrame -> DataFrame operators
    plans/      domain compositions (marts, projection, grading, board)
    streaming/  incremental ingest of newly landed partitions
"""

from touchline.session import get_session

__all__ = ["get_session"]
