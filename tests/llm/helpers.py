"""Small fixtures shared by the tests of the training-data operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Documents from ``(doc_id, text[, lang[, source]])`` tuples."""
    full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def components(nodes, linked):
    """node -> smallest node reachable, by plain search."""
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        queue = [n]
        out[n] = n
        while queue:
            x = queue.pop()
            for y in nodes:
                if y not in out and linked(x, y):
                    out[y] = n
                    queue.append(y)
    return out
