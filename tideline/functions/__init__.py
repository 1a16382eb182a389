"""Column-level feature families: each gives a Feature for one column and one parameter."""
