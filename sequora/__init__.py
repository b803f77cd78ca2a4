"""Temporal payment-graph preparation on Spark."""
