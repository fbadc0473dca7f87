"""The product datasets, their checks and the daily run."""
