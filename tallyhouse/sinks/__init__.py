"""Outputs: files, Kafka topics, console, catalog."""
