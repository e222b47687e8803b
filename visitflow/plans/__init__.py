"""The extracts and reviews, each a composition of operators over the source tables."""
