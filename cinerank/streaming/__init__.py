"""Structured Streaming: log filter, message sources, recommender and keyed state."""
