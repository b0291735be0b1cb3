"""The data jobs, as functions from frames to frames."""
