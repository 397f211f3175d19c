"""skewkit: skew-, null-, fan-out- and file-size-aware retail analytics on PySpark.

Every public function takes and returns DataFrames; none creates a session.
Sub-packages:

* ``sources``   – declared-schema table reads, seeded generators, file census,
                  Spark event-log tables.
* ``sinks``     – overwrite and size-targeted Parquet writes.
* ``functions`` – column expressions (exact money sums, repeatable hash
                  uniforms and salts, derived skew / null keys).
* ``operators`` – joins (shuffled, broadcast with a size check, salted,
                  left outer, guarded cross), aggregates (plain, salted
                  two-stage), ordering, profiles, cached reuse, event-log
                  diagnostics.
* ``plans``     – the retail star mapped onto the driver tables, the
                  composed queries registered in ``__spark_entry__``, the
                  reference's retail job end to end, and data-sized settings.
* ``streaming`` – incremental ingestion of event logs as they are written.
"""

__version__ = "0.1.0"
