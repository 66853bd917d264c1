"""DataFrame operators: trailing-time windows, rules, alerts, screening, windows, joins."""
