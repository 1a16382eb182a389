"""Planners: policy, catalogue and column names decide on the driver which features a stage adds; Spark computes them."""
