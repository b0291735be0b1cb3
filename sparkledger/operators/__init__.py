"""Reusable DataFrame operators: joins, updates, change sets, keys, hierarchy, retention, masking, export."""
