"""Order-risk, model-evaluation and retrieval analytics as PySpark DataFrame operators."""

__version__ = "0.1.0"
