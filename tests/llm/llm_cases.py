"""Rows and paths that the tests of several operators share."""

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
EDGE_TEXTS = [None, "", " \n\t", "a", "a b", "word " * 30_000, "tie one two", "tie one two", "ÄÖ \U0001f600 x"]
EDGES = [(k, t, [None, "en", "de"][k % 3], [None, "s1", "s2", ""][k % 4]) for k, t in enumerate(EDGE_TEXTS)] + [
    (3, "a", "en", "s1"),
    (None, "without an id", None, None),
]
