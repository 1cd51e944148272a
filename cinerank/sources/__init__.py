"""Sources and sinks: delimited text ingest, named tables, and stand-in test inputs."""
