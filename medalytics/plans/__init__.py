"""Ready plans: the parliamentary layers, and the queries over the standard tables with their oracles."""
