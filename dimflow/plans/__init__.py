"""Jobs: dimensions, logs, facts, bridges and landings built from the operators."""
