"""Spark-native photo triage, feature and duplicate-relationship analytics."""
