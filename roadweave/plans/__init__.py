"""Ready-made pipelines over the input tables."""
