"""Reading raw feeds and writing tables, exports and reports."""
