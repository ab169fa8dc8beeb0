"""Ready-made measures and the three pipelines built from the operators."""
