"""Labelling sensor data and preparing training text as Spark DataFrame plans."""
