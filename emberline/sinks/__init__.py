"""Writers of Bronze, Gold, predictions, run summaries and SQL names."""
