import pytest

#: Extra columns whose names the operators use themselves, and a case twin.
CLASH = ["row", "size", "node", "TEXT", "_1", "text_key", "position"]


@pytest.fixture
def frame(spark):
    def make(rows, source=True, parts=3):
        """rows: (doc_id, text, lang, source); n_chars and clashing columns are added."""
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
        full = [(i, t, lang, s, None if t is None else len(t), *["x"] * len(CLASH)) for i, t, lang, s in rows]
        old = spark.conf.get("spark.sql.caseSensitive")
        spark.conf.set("spark.sql.caseSensitive", "true")
        try:
            return spark.createDataFrame(full, schema).repartition(parts)
        finally:
            spark.conf.set("spark.sql.caseSensitive", old)

    return make


@pytest.fixture
def corpus():
    """Rows with copies, near copies, nulls, empty and blank texts, ties, a long text, repeated rows and null ids."""
    import random

    r = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(r.choice(words) for _ in range(r.randint(30, 120))) for _ in range(12)]
    rows = []
    for i in range(60):
        text = base[i % 12]
        if i % 3 == 1:
            parts = text.split()
            parts[r.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        elif i % 3 == 2:
            text = "  " + text.replace(" ", "\n", 4).upper() if i % 2 else text + " \t"
        rows.append((i * 7 % 101 + 1000 * (i % 4), text, ("en", "de", None)[i % 3], ("a", "b", None, "a", "a")[i % 5]))
    rows += [(1, None, "en", "a"), (2, "", "en", "b"), (3, " \n\t", None, None), (4, "", "en", "b"), (5, "one two", "en", "a"), (6, "one two", "en", "c"), (6, "one two", "en", "c"), (None, "one  two", "en", "c"), (None, base[0], "en", None)]
    rows.append((7, " ".join(r.choice(words) for _ in range(20_000)), "en", "long"))
    return rows
