"""Workforce contingency analytics as lazy DataFrame operators on Spark."""
