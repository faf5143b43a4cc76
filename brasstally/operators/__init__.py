"""Reusable relational steps: newest version, gates, rules, skew-safe joins and totals."""
