"""Spark-native analytics for acoustic event detections.

Every operator is a function ``(DataFrame, parameters) -> DataFrame`` that only
builds a plan.  Modules that must run a job say so in their docstring.
"""
