"""Sources of changes: snapshots, the change log, JDBC tables, and the logical replication protocol."""
