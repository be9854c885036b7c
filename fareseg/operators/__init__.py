"""fareseg.operators."""
