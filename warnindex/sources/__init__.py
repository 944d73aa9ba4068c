"""Sources and sinks: file scans, decoders, landed pages, partitioned tables, test-table adapters."""
