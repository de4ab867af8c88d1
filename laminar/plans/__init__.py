"""Plans: the daily run, catalog setup, and the registry of warehouse queries."""
