"""Operators on whole tables: release groups, alignment, folding, sampling and reports."""
