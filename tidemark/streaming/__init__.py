"""The jobs over streams."""
