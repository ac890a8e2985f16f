"""Sources and sinks: table scans, file ingestion, artefact writers."""
