"""End-to-end queries over a table directory, and their SQL oracles."""
