from rillet.sources.files import (parse_access_log, parse_behavior_csv, parse_sensor_csv,
                                  read_csv_table, read_text)
from rillet.sources.kafka import kafka_csv_decode, kafka_csv_encode
from rillet.sources.tables import (access_log_lines, access_log_from_events, behavior_from_events,
                                   load_table, sensor_from_events)

__all__ = ["parse_access_log", "parse_behavior_csv", "parse_sensor_csv", "read_csv_table",
           "read_text", "kafka_csv_decode", "kafka_csv_encode", "access_log_lines",
           "access_log_from_events", "behavior_from_events", "load_table", "sensor_from_events"]
