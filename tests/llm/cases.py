"""Small inputs with every odd case: NULLs, empty and long texts, ties, copies, clashing columns."""

import random

WORDS = ["alpha", "Beta", "gamma", "delta", "ÉTÉ", "über", "one", "two", "three", "four", "five"]


def text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def odd_documents(spark, columns="doc_id long, text string, lang string, row int, hash string, n int, kept string"):
    """Rows with the columns of the operators' own intermediates among them."""
    rng = random.Random(7)
    long_text = "\n".join(text(rng, 12) for _ in range(1500))
    copy = "\n".join(text(rng, 12) for _ in range(6))
    texts = [None, "", " \n\t ", "x", "A b", "a B", "É", "é", long_text, long_text + "\nend of it"]
    texts += [copy] * 40 + [copy.upper(), copy + "\nlast line", "first line\n" + copy]
    texts += ["\n".join(text(rng, 12) for _ in range(5)) for _ in range(20)]
    rows = [(i, t, "en", 1, "h", 2, "k") for i, t in enumerate(texts)]
    rows += [(None, copy, None, None, None, None, None), (None, None, None, None, None, None, None)]
    rows += [(3, "x", "en", 1, "h", 2, "k"), (3, "x", "en", 1, "h", 2, "k")]
    return spark.createDataFrame(rows, columns)


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def az(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
