"""Query plans: the queries of each part of the engine, by name."""
