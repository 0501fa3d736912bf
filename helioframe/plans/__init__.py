"""helioframe plans."""
