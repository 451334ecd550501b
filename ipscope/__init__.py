"""ipscope — scored IP threat profiles built from DataFrame, SQL and Structured Streaming.

Feeds of abuse reports, threat pulses and geolocation are normalised into typed
tables, joined, classified, scored and merged into a keyed profile store.  All
per-row logic is native Spark expressions (no Python UDFs), so plans stay inside
whole-stage codegen and scale with the cluster.
"""

from ipscope.session import get_session, checkpoint_root  # noqa: F401

__all__ = ["get_session", "checkpoint_root"]
