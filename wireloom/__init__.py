"""wireloom: collecting, cleaning, checking and publishing news-like text as Spark jobs."""

__version__ = "0.1.0"
