"""Column-level building blocks: type rules, text forms, fingerprints."""
