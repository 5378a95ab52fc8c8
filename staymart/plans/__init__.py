"""Booking-level plans assembled from the operators."""
