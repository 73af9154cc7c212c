"""Spark-native analytics for property-sale transactions.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects
(or Column expressions) and never creates a session; the plan is declared
lazily and executed by Catalyst/Tungsten.  Sub-packages:

* ``sources``   – typed readers/writers for the two registry dialects and the
                  proxy sales view built from the driver tables.
* ``functions`` – Column-level helpers (parsing, calendars, labels, safe
                  arithmetic, distribution functions as pandas UDFs).
* ``operators`` – DataFrame -> DataFrame operators (cleaning, district
                  medians, profiling, association tests, monthly panels,
                  forecasting jobs, evaluation, chart data).
* ``plans``     – end-to-end pipelines and the query catalogue.
* ``streaming`` – incremental ingestion of new registry extracts.
"""

__version__ = "0.1.0"
