"""Composite jobs: reconcile, run/accumulate zones, diagnose."""
