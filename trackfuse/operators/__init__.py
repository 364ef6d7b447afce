"""DataFrame to DataFrame operators, for batch and streams alike."""
