"""Readers that turn stored tables into the log / users / items schemas, and sinks."""
