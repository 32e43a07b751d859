"""reviewlake — review analytics as lazy Spark DataFrame operators.

Every public operator takes and returns a ``DataFrame`` (or a ``Column``)
and never triggers a job by itself unless its name says so (gates, sinks,
streaming runs).  Layout:

* ``functions``  pure ``Column`` helpers (text, numbers, time, JSON)
* ``sources``    table readers, the ``reviews`` adapter, payload normalisers
* ``operators``  filters, projections, classification, sentiment, dedup,
                 upsert, aggregates and the explorer
* ``sinks``      file / JDBC / topic writers and run-metric records
* ``streaming``  topic ingest and stream → table upsert
* ``plans``      composed jobs (processing job, collection, batch load, gates)
"""

from reviewlake.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
