"""Sources and sinks: fixture adapters, JSON change batches, incremental extract, tables."""
