"""The five jobs, wired from the operators: batch runs and streams."""
