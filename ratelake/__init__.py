"""ratelake: venue-rating analytics on Spark.

Batch ETL with a dead-letter queue, feature encoding and per-group context,
a Parquet lake partitioned by country, a JSON topic consumed with Structured
Streaming, column profiling and MLlib regression, all composed from
DataFrame / Structured Streaming / MLlib built-ins.
"""

from ratelake.contract import (  # noqa: F401
    CONTRACT_COLUMNS,
    CONTRACT_SCHEMA,
    CRITICAL_COLUMNS,
    FEATURE_COLUMNS,
    NUMERIC_COLUMNS,
)

__version__ = "0.1.0"
