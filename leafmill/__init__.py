"""leafmill: analytics over large document corpora, written as Spark plans."""

__version__ = "0.1.0"
