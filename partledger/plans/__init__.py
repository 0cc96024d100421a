"""Jobs composed of operators, and the analytic queries over the published tables."""
