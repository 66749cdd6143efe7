"""Writing files, tables and run records."""
