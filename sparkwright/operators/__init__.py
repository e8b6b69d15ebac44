"""DataFrame operators, grouped by the stage of the analytical path they serve."""
