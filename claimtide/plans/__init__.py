"""Report pipelines composed of the operators."""
