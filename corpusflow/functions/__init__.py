"""Column functions: each takes and returns Columns, nothing runs here."""
