"""Column functions: year-week arithmetic and guarded numeric helpers."""
