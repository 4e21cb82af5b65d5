"""lumaset: a Spark-first engine for preparing and auditing image-and-label datasets."""

__version__ = "0.1.0"
