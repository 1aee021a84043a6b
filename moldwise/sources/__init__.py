"""Inputs and outputs: file readers/writers and the fixture views over the
shared test tables."""
