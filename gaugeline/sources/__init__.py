"""Sources and sinks: dimensions, readings, storage tables, test tables."""
