"""DataFrame operators: dedup, joins and conformance, reshaping, sinks,
incremental maintenance, type-2 history and data-quality checks."""
