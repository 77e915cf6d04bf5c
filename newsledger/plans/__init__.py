"""Composite jobs: each one declares a plan from the operators."""
