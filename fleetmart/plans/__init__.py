"""Load, marts and reports, composed from the operators."""
