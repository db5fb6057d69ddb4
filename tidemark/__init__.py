"""tidemark — a Spark-native bronze/silver/gold warehouse library.

Subpackages:

* ``sources``   — bronze reads, catalog DDL, partitioned/versioned sinks;
* ``functions`` — Column expressions (text cleaning, safe casts, exact sums);
* ``operators`` — DataFrame -> DataFrame operators: gates, resolution,
                  dedup, merges, SCD2, point-in-time joins, windows,
                  metrics, data quality, extraction;
* ``plans``     — gold views, the registered driver queries, layer runners;
* ``streaming`` — incremental (micro-batch) SCD2 loading.
"""

__version__ = "0.1.0"
