"""eventlake: Spark-native event-listing and customer-purchase analytics.

Layers (all PySpark DataFrame / SQL / Structured Streaming):

* ``sources``   – feed registry, CSV/binary readers, HTML page extraction
* ``functions`` – Column -> Column building blocks (Portuguese dates, text, hashing)
* ``operators`` – DataFrame -> DataFrame steps (silver, gold, serving, clients, ...)
* ``sinks``     – table / CSV writers, archive, keyed upsert
* ``streaming`` – incremental ingest and continuous upsert
* ``plans``     – end-to-end jobs and the adapters that shape the driver tables
"""

from eventlake.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
