"""Column functions: stamps, text, labels and visit durations."""
