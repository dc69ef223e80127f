"""Stream sources (Kafka / file-backed envelope), dimensions, tables."""

from .dims import read_dimension, route_schedule, zone_profile  # noqa: F401
from .streams import (event_time, fan_in, kafka_options, read_kafka, read_topic_files,  # noqa: F401
                      short_topic, table_stream)
