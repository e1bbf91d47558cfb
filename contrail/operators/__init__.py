"""DataFrame-to-DataFrame operators: staging, enrichment, trajectories, hexagons, state, quality."""
