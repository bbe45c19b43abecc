"""voxmill: a Spark-first engine for curating and analysing speech corpora."""

__version__ = "0.1.0"
