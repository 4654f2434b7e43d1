"""Query plans: one module per SURVEY section, each registering its keys."""
