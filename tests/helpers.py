"""Values that several test modules use."""

#: The smallest of the given tables.
SMALL = "/root/testdata/sf0.001"
