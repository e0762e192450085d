"""Bare-soil features from satellite reflectance series, as Spark DataFrame plans."""
