"""DataFrame operators of the three workloads."""
