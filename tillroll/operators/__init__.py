"""DataFrame operators: join/enrich, filters, grouped reports, ranking."""
