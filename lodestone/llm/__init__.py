"""Training-data operators on entities and texts; nothing outside this package imports it."""
