"""Multi-operator plans, and the query catalogue with its SQL oracle."""
