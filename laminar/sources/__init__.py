"""Sources: driver tables bound to the raw-layer contracts, seed rows, written
warehouse tables (partition-pruned reads), JDBC extracts and log files."""
