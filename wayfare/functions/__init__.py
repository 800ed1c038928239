"""Column expressions: text, time, codecs, geography."""
