"""riskframe: related history tables -> one governed, model-ready feature table, on Spark."""

__version__ = "0.1.0"
