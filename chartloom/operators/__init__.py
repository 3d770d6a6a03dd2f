"""Relational and modelling operators: functions from DataFrames to DataFrames."""
