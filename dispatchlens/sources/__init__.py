"""Sources and sinks of feeds and results."""
