"""Whole jobs on a snapshot, composed from the operators."""
