"""Multi-operator flows and the query catalog."""
