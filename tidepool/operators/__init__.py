"""Reusable distributed building blocks."""
