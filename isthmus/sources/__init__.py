"""Names, types, tables, catalogs, credentials and sinks."""
