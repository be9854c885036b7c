"""fareseg.sources."""
