"""Keyed JSON, partitioned Parquet and idempotent window sinks."""

from .writers import (kafka_sink_options, keyed_json, start_keyed_json, start_parquet,  # noqa: F401
                      trigger_args, upsert_partitions, versioned_append)
from .committed import CommittedTable, into_tables  # noqa: F401
