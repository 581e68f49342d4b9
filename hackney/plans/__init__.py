"""Query plans: table bindings, the query catalog and its SQL checks."""
