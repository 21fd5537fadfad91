"""tidewater: replay-safe JSON event ingestion on Spark.

Messages arrive as Kafka-style envelopes (or files holding the same
envelope), are decoded against a fixed schema in one pass, split into
accepted rows and dead-lettered rows with a reason, and land in a keyed
table where the last write per key wins and a replayed batch changes
nothing.  Around that sit running word counts, per-run attempt statistics
with streak and duration cut-offs, and latency summaries over JSON logs.

Every transform is a ``DataFrame -> DataFrame`` function that works on a
batch or a streaming DataFrame alike; only ``sources``, ``sinks`` and
``streaming`` know how data enters and leaves.
"""

__version__ = "0.1.0"
