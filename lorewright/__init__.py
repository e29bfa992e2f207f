"""Lorewright: a Spark-native engine for analysing collections of scientific papers."""
