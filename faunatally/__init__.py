"""Faunatally: field-observation analytics as lazy Spark DataFrame operators."""
