"""Multi-stage jobs composed from the operators."""
