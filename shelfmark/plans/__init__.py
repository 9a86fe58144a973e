"""The tables the engine produces, and the loads that keep them."""
