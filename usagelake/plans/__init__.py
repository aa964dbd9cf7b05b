"""Composite jobs: intake, cycles, masters, rules, billing, reports, checks."""
