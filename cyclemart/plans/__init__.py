"""End-to-end cycle jobs (``jobs``) and the query catalogue on the driver tables."""
