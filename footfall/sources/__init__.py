"""Inputs and outputs: captures, CSV folders, catalog tables."""
