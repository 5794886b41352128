"""DataFrame operators: conformance, quality gates, upsert, profiling."""
