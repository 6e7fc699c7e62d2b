"""Spark-native forensic event analytics: tool output in, normalised CAR events, links, timelines and rule hits out."""
