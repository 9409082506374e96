"""Ride and fleet analytics warehouse as plain Spark DataFrame functions."""
