"""Sources and sinks: table loading, collector CSVs, payloads, pages."""
