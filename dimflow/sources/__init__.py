"""Reading and writing tables, reports and landing files."""
