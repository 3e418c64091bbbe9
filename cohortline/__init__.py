"""cohortline: longitudinal clinical event cohorts built with Spark DataFrames.

Layout:
  sources/    readers (by prefix, CSV/Parquet), sinks (cohort, catalogue, splits), fixtures
  functions/  Column builders: code normalisation, time parsing, code templates, values
  operators/  DataFrame -> DataFrame steps: preparation joins, event extraction,
              subjects and shards, cohort finalisation, code metadata, audit, links
  plans/      the event specification, the end-to-end ETL, registered queries and oracles
  streaming/  incremental landing and event extraction with Structured Streaming
"""

from cohortline.session import ensure_conf, get_session, scratch_dir

__all__ = ["ensure_conf", "get_session", "scratch_dir"]
