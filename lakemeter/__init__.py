"""lakemeter: Spark-native operators and batch pipeline for interval measurements and forecasts.

Every operator is a DataFrame -> DataFrame function; planning and execution are left to
Catalyst, AQE and the cluster.  Sub-packages:

* ``functions``  column-level helpers (time zones, calendar keys, hashes, number cleaning)
* ``sources``    landed payload scans, parsing, source contracts, manifest reconciliation
* ``operators``  dedup, rule labelling, completeness, facts, dimensions, quality, statistics
* ``plans``      keyed table writes, the Bronze -> Silver -> Gold pipeline, report queries
* ``streaming``  incremental landing with Structured Streaming
"""

__version__ = "0.1.0"
