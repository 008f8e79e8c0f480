"""Sources and sinks: table reads, feature views, validation, model tables."""
