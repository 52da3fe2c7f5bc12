"""Sources and sinks: driver tables, CSV feeds, JSON messages, document tables."""
