"""The query workload: the library's jobs bound to a TPC-H-like set of tables."""
