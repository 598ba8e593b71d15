"""The given tables, fixture adapters, file readers and sinks."""
