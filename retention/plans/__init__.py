"""End-to-end plans (weekly processing, training, inference) and the query catalog."""
