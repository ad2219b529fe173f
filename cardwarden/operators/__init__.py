"""DataFrame-to-DataFrame operators: staging, incremental load, dimension merge, checks."""
