"""Trailhead: a PySpark-native wayfinding analytics engine."""
