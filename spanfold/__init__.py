"""Household span analytics on Spark."""
