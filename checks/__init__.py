"""The registered queries over the sample tables, and SQL that computes the same on another engine."""
