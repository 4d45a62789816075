"""supplyscope: consumable-supply analytics for a device fleet on Spark.

Everything is expressed as DataFrame / Column code over Spark built-ins so
Catalyst can prune, push down and code-generate it.  Sub-packages:

* ``functions``  Column -> Column helpers (key normalisation, percent text,
  status, severity and alert bands).
* ``sources``    table readers/writers, captured-page gauge extraction and the
  adapters that shape the shared test tables into fleet tables.
* ``operators``  merge, history, reshape, skew-aware series sequencing and the
  depletion forecasts.
* ``plans``      composite jobs (refresh, forecast, severity report) and the
  query catalogue used by ``__spark_entry__``.
* ``streaming``  Structured Streaming ingest of readings.
"""

__version__ = "0.1.0"
