"""Part of transpark."""
