"""Reproducible exports of document collections on Spark."""
