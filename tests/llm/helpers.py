"""Small awkward tables and brute-force versions."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, bucket long, r string, __id long, __hash string, __h long, __n int, Key string, rest struct<a: int, text: string>, none date"


def docs(spark, rows):
    """Rows of (doc_id, text[, lang, source]); with extra columns whose names operators use inside."""
    full = [(i, t, *(rest or ("en", "s")), 0, "x", 1, "y", 5, "h", 6, 7, "k", (1, "t"), None) for i, t, *rest in rows]
    return spark.createDataFrame(full, DOCS)


LONG = " ".join(f"word{i % 97} other{i % 31}" for i in range(30_000))
AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "one", "en", None), (5, "one  two", "de", "b"), (6, "one two", "de", "b"),
    (7, LONG, "en", "c"), (7, LONG, "en", "c"), (8, "The quick brown fox " * 40, "en", "a"), (9, "The quick brown fox " * 40 + "jumps", "en", "a"),
    (None, "no id at all", "en", "a"), (10, "12345 !!! ###", "en", "b"), (11, "één ß 日本語 \U0001f600 \x00 end", "fr", "c"),
]


def find_groups(n, linked):
    """Smallest member of each component, by brute force."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return [find(i) for i in range(n)]


def plans_of(monkeypatch, *modules):
    """The plans of the tables that these modules save, by name."""
    found, save = {}, modules[0].save

    def keep(df, name="t"):
        found.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return save(df, name)

    for m in modules:
        monkeypatch.setattr(m, "save", keep)
    return found
