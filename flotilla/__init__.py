"""Fleet-logistics analytics on Spark.

Batch: read vehicles, deliveries, GPS pings, incidents and a system log; clean them by
stated rules; roll them up per vehicle; join one report row per vehicle; publish tables.
Stream: decode keyed JSON events, raise alerts, count events and alerts in watermarked
tumbling windows. Dashboard: headline KPIs and chart series computed on Spark.

Every transform is a plain ``DataFrame -> DataFrame`` function built from Spark built-ins,
so Catalyst sees the whole plan (pruning, pushdown, partial aggregation, AQE).
"""

__all__ = ["session"]
