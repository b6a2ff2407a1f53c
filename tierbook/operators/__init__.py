"""DataFrame operators: latest batch, enrichment joins, lookback, feature book,
control rows and readiness."""
