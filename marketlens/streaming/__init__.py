"""Structured Streaming: line sources, anomaly filter, relays and sinks."""

from .anomalies import parse_stream, stream_anomalies, without_repeats
from .relay import deal, relay_to_kafka, relay_to_lines, spool_draws, spool_samples
from .run import await_all, run_available, run_together, stop_gently, write_console, write_parquet
from .sources import kafka_lines, spool_lines

__all__ = [
    "await_all",
    "deal",
    "kafka_lines",
    "parse_stream",
    "relay_to_kafka",
    "relay_to_lines",
    "run_available",
    "run_together",
    "spool_draws",
    "spool_lines",
    "spool_samples",
    "stop_gently",
    "stream_anomalies",
    "without_repeats",
    "write_console",
    "write_parquet",
]
