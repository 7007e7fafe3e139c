"""Query plans: derived inputs and the registry of checked queries."""
