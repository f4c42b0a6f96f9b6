"""Ready-made queries over the events table and their SQL counterparts."""
