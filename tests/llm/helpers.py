"""Brute-force helpers of the tests."""


def components(nodes, links):
    """Smallest node reachable, per node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def docs_of(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id bigint, text string" + extra)
