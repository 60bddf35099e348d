"""Whole jobs: preparing the clean table and computing the report."""
