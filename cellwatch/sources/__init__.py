"""Sources and sinks: driver tables, raw device tables, CSV, file choice, models."""
