"""Sources and sinks: object containers, topics, logs and metric lines."""
