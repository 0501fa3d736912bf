"""helioframe operators."""
