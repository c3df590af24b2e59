"""windtally — windowed comment analytics on Spark.

Every transform is a ``DataFrame -> DataFrame`` function shared by batch and
Structured Streaming.  Sub-packages:

* ``sources``   — readers/decoders (CSV, keyed JSON, Kafka options) and sinks
* ``functions`` — column expressions (window specs, 2h buckets, text rendering)
* ``operators`` — validity/quarantine, hierarchical window counts, ranking
* ``plans``     — the two queries composed from the operators, named catalog
* ``streaming`` — watermarking, checkpointed append-mode runners
"""

from windtally.session import get_spark, ensure_utc, checkpoint_root

__all__ = ["get_spark", "ensure_utc", "checkpoint_root"]
