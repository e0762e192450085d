"""Work that arrives over time. Inputs are finite, so runs are incremental batches."""
