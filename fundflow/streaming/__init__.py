"""Streams into the bronze layer."""
