"""Where decoded records go: keyed table, dead letters, Kafka, console, logs."""
