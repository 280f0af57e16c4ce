"""Composite models: staging, dimensions, facts, reports, monitors, onboarding."""
