"""The provided Parquet tables seen as warehouse tables, and the registered queries."""
