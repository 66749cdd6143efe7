"""Reading files, tables and run records."""
