"""Operators on texts and pages for training data, and the queries that apply them to whole tables."""
