"""Composed plans: medallion tables, alert reports, the query catalogue and its SQL oracle."""
