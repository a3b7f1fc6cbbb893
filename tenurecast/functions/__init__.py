"""Column-level and order-statistic helpers."""
