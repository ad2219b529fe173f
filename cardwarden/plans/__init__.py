"""Whole dataflows built from the operators: fraud rules, warehouse, nightly run."""
