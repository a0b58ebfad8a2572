"""Whole plans: the six-report pipeline and the registered queries over the driver tables."""
