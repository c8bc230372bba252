"""DataFrame operators: logs, visits, changes, dimensions and orders."""
