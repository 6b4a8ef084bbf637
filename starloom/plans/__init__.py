"""User-level jobs: staging, dimensions, facts and the daily run."""
