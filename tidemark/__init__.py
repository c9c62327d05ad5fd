"""Change replication and reconciliation of a mutable table, on Spark."""
