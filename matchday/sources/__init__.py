"""Sources (landed-file ingest) and sinks (table write semantics)."""
