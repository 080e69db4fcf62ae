"""Scans, generators and sinks."""
