"""DataFrame-level operators: joins, keep-best, lag, shape changes, splits."""
