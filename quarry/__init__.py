"""quarry: ranked full-text retrieval (clean, normalise, index, tf-idf,
cosine top-k) as Spark DataFrame jobs.  See README.md."""

__version__ = "0.1.0"
