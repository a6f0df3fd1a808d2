"""Spark-native analytics over recorded video: which text was visible on which camera, when and how legibly."""

__version__ = "0.1.0"
