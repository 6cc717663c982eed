"""Whole plans: training, prediction and the registered queries."""
