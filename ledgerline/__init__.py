"""Spark-native governance of patent metadata: load, standardise, clean, route, merge, audit."""
