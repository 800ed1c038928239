"""The reports: one function per report, tables in, table out."""
