"""helioframe models."""
