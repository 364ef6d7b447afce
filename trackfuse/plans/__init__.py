"""The jobs: ingest, features, models. Batch and streams share every transformation."""
