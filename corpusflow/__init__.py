"""corpusflow: turn landed posts and repository files into retrieval tables on Spark."""

__version__ = "0.1.0"
