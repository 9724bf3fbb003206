"""The driver's tables seen as an interaction model, with queries and their SQL twins."""
