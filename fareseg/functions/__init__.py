"""fareseg.functions."""
