"""Sources and sinks: text-line ingest, driver-table adapters, line damage, report writers."""
