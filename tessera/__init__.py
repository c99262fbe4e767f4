"""Tessera: a Spark-native entity-resolution and corpus analytics engine."""
