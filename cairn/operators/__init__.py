"""Operators: numeric statistics, word counts, sampling, assignment and k-median."""
