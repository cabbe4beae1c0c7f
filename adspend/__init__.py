"""Allocation of next-day ad spend on Spark."""
