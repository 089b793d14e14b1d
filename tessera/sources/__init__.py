"""tessera.sources."""
