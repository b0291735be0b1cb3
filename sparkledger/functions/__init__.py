"""Column functions with the semantics the jobs need."""
