"""Column-level building blocks: labels, literals, time ranges and predicates."""
