"""tessera — incremental-warehouse operators on Spark DataFrames.

Landed feeds are flattened, typed, de-duplicated and unified by priority,
rolled up to a daily grain, versioned as a Type-2 dimension, joined as-of into
facts, kept current by watermark and touched-key upserts on partitioned
Parquet (batch or Structured Streaming), gated by data-quality tests, and
queried by a small set of dashboard marts.

Every operator is a function ``(DataFrame, ...) -> DataFrame`` built from the
DataFrame API so Catalyst/AQE plan it; nothing is collected to the driver
except bounded scalars (a watermark, a handful of touched days).
"""

from tessera.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
__version__ = "0.1.0"
