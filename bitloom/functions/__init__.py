"""Scalar functions as native columns; Arrow functions only for splitting, encoding and chrF."""
