"""Spark DataFrame operators for sequencing metadata, reads and feature tables."""
