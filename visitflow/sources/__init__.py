"""Source tables, sink contracts and loading."""
