"""The marketplace's jobs: conforming, metrics, star schema, views, reports, audit, daily run."""
