"""Models (staging, warehouse, marts, analyses), the materialising build,
write-path jobs, the query catalogue and its SQL oracles."""
