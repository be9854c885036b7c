"""fareseg.streaming."""
