"""Trajectory and route analytics as PySpark DataFrame operators."""
