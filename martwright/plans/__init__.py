"""Batch flows that chain the operators from feed files to KPIs."""
