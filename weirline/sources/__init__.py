"""Raw extracts in, tables and files out."""
