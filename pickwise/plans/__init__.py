"""End-to-end jobs (read -> operators -> write) and the registered queries."""
