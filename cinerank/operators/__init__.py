"""Operators: statistics, top-k, similarity kernels, content features, ALS and real-time scoring."""
