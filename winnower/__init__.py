"""Instruction data cleaning and model score comparison on Spark."""
