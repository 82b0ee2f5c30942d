"""Column-level building blocks: everything here returns a Spark Column."""
