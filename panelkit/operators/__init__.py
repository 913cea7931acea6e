"""Joins, lookbacks, distributed ranks and quantiles, imputation, metrics and drift."""
