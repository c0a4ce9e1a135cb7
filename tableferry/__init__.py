"""tableferry: move relational tables with Spark and prove that they arrived intact."""

__version__ = "0.1.0"
