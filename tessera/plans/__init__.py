"""tessera.plans."""
