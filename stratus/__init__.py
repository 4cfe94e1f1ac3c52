"""stratus — station-to-area measurement warehouse as composable Spark DataFrame operators.

Layers (all lazily composed DataFrame -> DataFrame functions):

* ``sources``   landing-zone readers (station lists, weather response documents, postal polygons)
                and stand-in raw tables derived from the driver's parquet tables;
* ``functions`` Column-level helpers (measure spec, JSON field extraction, planar geometry, circular stats);
* ``operators`` relational building blocks (clean, dedup, surrogate keys, nearest link, star joins,
                marts, quality checks, keyed incremental replace);
* ``plans``     the composite models (staging -> dims -> link -> facts -> marts) and the query registry;
* ``streaming`` the hourly feed as a Structured Streaming ``foreachBatch`` job.
"""

from stratus.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
