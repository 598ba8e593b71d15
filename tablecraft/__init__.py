"""tablecraft: reusable Spark table operators and the analyses built from them.

Layout:
    sources/    the given tables, fixture adapters, readers and sinks
    functions/  column expressions (text, time, cleaning rules, UDF forms)
    operators/  DataFrame-in, DataFrame-out operators and analyses
    plans/      the registered analyses and their DuckDB twins
    streaming/  incremental ingest of file drops (Structured Streaming)
"""

__version__ = "0.1.0"
