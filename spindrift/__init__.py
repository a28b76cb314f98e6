"""Spindrift: a Spark-native engine for barcode counting and tabular analytics."""
