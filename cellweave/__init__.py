"""cellweave: spatial single-cell analytics and training-data preparation as PySpark plans."""

__version__ = "0.1.0"
