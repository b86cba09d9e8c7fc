"""Streaming: from the change log through rules and routes to a sink, in micro-batches."""
