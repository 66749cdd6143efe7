"""DataFrame operators that take column names, so they serve any table."""
