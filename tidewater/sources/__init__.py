"""How messages enter: Kafka, envelope files, text lines, landed responses."""
