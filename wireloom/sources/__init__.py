"""Reading tables, and the store that batches are written to."""
