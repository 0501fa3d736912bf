"""helioframe sources."""
