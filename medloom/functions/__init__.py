"""Part of the medloom engine."""
