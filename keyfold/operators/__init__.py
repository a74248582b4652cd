"""DataFrame operators on keyed events."""
