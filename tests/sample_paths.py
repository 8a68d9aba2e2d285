"""Paths of the driver's tables (a module of its own: two folders hold a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
