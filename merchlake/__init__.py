"""Merchlake: e-commerce data operators, reports and jobs for Spark."""
