"""Folders of the given tables that the tests read."""

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
