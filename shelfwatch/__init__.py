"""Retail product snapshot analytics on Spark."""
