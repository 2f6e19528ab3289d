"""valence: a PySpark-native text polarity engine.

Cleans and tokenises labelled text with column expressions, builds
deterministic vocabularies and term counts, trains and applies an
unsmoothed categorical naive Bayes, an exact k-nearest-neighbour vote and a
linear model over pooled word vectors, evaluates them, and normalises,
de-duplicates, scores and publishes news-feed records in batch or as a
Structured Streaming job.
"""

__version__ = "0.1.0"
