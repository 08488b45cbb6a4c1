"""Structured Streaming counterparts of the bronze and silver layers."""
