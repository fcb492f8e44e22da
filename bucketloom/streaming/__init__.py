"""The rollup as a stream: event-time watermark for sealing, append mode, idempotent writes."""
