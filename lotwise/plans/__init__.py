"""Models: staging, the permit core, marts, the map view, quality checks, the daily run."""
