"""Query plans: fixture views from the test tables and the registered queries."""
