"""Topics and rule changes as batch or streaming DataFrames."""
