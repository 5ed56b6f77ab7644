"""sources of the engine."""
