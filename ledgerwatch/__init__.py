"""ledgerwatch: order-pipeline and observability analytics on PySpark.

Layout
------
sources/    typed contracts, fixture derivations from the test tables, table sinks
functions/  small Column helpers (severity rank, minute diff, epoch buckets, templates)
operators/  the DataFrame operators: upsert, marts, report, audit, logs, series, alerts
plans/      configuration-driven plans: alert policies and dashboard panels
streaming/  Structured Streaming variants: CDC upsert, streaming alignment, absence state
"""

__version__ = "0.1.0"
