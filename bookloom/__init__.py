"""bookloom: a Spark engine that curates, measures and packs collections of books."""

__version__ = "0.1.0"
