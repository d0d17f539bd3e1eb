"""Column-level functions: cleaning, audit columns, the JSON wire format."""
