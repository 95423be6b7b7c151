"""The jobs: land raw files, correct the facts, publish the open-data table, verify it."""
