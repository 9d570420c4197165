"""The jobs: ingest, bronze, silver, gold, analytics, alerts, weather, warehouse."""
