"""Analyses of e-commerce sales records as Spark DataFrame operators."""
