"""carelake — a Spark-native healthcare warehouse and KPI engine.

Layers: raw -> staging -> ods -> dwh (8 dimensions, 5 facts) -> datamart -> KPIs.
Every transformation is a DataFrame / Column expression planned by Catalyst; there
are no Python UDFs and no data rows pass through the driver.

Sub-packages
------------
functions   Column-expression library (cleaning, ordered rule classifiers, calendar)
operators   reusable relational operators (surrogate keys, lookups, containment
            joins, aggregate helpers, SCD-2 history, schema alignment, quality checks)
sources     readers and writers (CSV trees, JDBC, Parquet layers, audit rows)
plans       the model graph (staging, ods, dwh, marts), KPI queries and the
            bindings of every operator to the driver's test tables
streaming   incremental fact loading with Structured Streaming (AvailableNow)
"""

from carelake.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
