"""Whole jobs: the five provider feeds as specs, and the monthly settlement run."""
