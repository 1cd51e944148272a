"""cinerank: a PySpark-native movie-recommendation analytics engine.

Batch jobs parse catalogue/rating/tag text into tables, compute popularity and
quality statistics, train collaborative filtering (ALS), build item-to-item
similarity lists (latent factors, embeddings, TF-IDF), and a Structured
Streaming job re-scores a user's candidates for each incoming rating.
"""

__version__ = "0.1.0"
