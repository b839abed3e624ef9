"""Compositions of the operators: the lazily derived warehouse over the given
tables, the stored daily load, and the query catalog."""
