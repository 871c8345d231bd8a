"""farebox — city trip-record analytics expressed as Spark DataFrame jobs.

Layers (each a plain function ``DataFrame(s) -> DataFrame``):

* ``farebox.sources``    inventory, Bronze files, landing append, manifest upsert, zone seed
* ``farebox.functions``  column expressions shared by every layer (keys, durations, rules)
* ``farebox.operators``  staging / silver, dimensions, facts, marts, checks, forecasting
* ``farebox.plans``      ordered build of all models, training runs
* ``farebox.streaming``  exactly-once incremental landing ingest (Structured Streaming)
"""

__version__ = "0.1.0"
