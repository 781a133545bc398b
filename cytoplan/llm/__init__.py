"""Operators for training-text pipelines. Nothing else in cytoplan imports this."""
