"""Column-level functions: text clean-up, character predicates, word-formation rules."""
