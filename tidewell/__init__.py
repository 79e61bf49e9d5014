"""Layered analytics and data-quality operators for PySpark."""
