"""contrail: a Spark-native dimensional warehouse for flight-delay analytics.

Every operator is a plain function from DataFrames (or Columns) to a DataFrame
(or Column) built from stock ``pyspark.sql`` primitives, so Catalyst plans the
whole chain and whole-stage codegen covers it.  No Python UDF runs anywhere.

Layout
------
``contrail.functions``  column expressions (cleaning, keys, clocks, calendar, measures)
``contrail.sources``    raw schemas, CSV / seed readers, the driver-table feed
``contrail.operators``  dedup, conformance joins, unpivot, sinks, incremental, history, quality
``contrail.plans``      staging / warehouse / mart models, analyses, build context, query catalog
``contrail.streaming``  file-arrival ingestion that reuses the incremental merge
"""

from contrail.session import configure, get_session, scratch_dir

__all__ = ["configure", "get_session", "scratch_dir"]
