"""Reading landing data and tables, and writing tables."""
