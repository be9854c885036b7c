"""fareseg.plans."""
