"""Streaming forms of the update trigger and the queue check."""
