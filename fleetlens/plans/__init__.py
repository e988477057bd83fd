"""Feature, split, model, feature-table and monitoring plans."""
