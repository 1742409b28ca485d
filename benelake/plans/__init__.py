"""End-to-end plans: lakehouse, warehouse, explorer, tiles, profile, sample, pipeline."""
