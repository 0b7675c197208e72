"""No streaming operators.

The reference processes weekly batches only: it has no stream source, watermark,
event-time window or stateful operator, so nothing here is built.  Batch jobs in
``tillcast.plans`` are idempotent over their inputs and can be re-run per new week.
"""
