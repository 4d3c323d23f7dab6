"""stopflow - timetable (scheduled-stop) ETL and analytics on Spark DataFrames.

Modules: ``schema`` (vocabulary), ``functions`` (column expressions),
``sources`` / ``sinks`` (I/O), ``operators`` (conform, clean, enrich,
analytics, slicers, lookups, profiling, quality), ``plans`` (jobs, derived
test inputs, named queries, oracle SQL), ``streaming`` (incremental ingest),
``session`` (session, shared folder, sizing).
"""

__version__ = "0.1.0"
