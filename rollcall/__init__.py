"""rollcall: keep a large people table in step with zone rosters, on Spark.

Sub-packages: ``functions`` (key normalisers as column expressions),
``operators`` (clean, cascade match, updates, dedupe, near-miss),
``sources`` (CSV/tab/snapshot I/O and tables derived from the test data),
``plans`` (composite jobs) and ``streaming`` (zone rosters as a stream).
"""

__version__ = "0.1.0"
