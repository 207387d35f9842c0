"""Assessments composed from the operators."""
