"""Readers and writers for trip data."""
