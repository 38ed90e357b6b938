"""Sedimenta: layered-table data jobs as PySpark DataFrame functions."""
