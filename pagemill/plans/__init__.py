"""Daily jobs: operators chained through stored day partitions."""
